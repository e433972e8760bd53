"""Training-data operators: dedup, scoring, tokenising, packing, archives.

Nothing outside this subpackage imports it; ``queries.py`` lists its queries.
"""
