"""Places of a map matched to companies and their observations (SRC-21, ID-07, ID-08, JON-12, JON-13, WIN-04).

Pairs come from an inverted index over keys that every accepted pair shares: a phone number, a suffix of the place's domain
that is the company's, or a postcode (a street's longest word, where the registry has no postcode) with a word of the name.
An address alone proves a place only where the name is there as a whole, so of a name's words those that the fewest places have
near the address are enough; more channels than that include the phone or the site. Address, phone, site and name are then
compared once for each pair. Only pairs whose domain agrees need the ratio of strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.frames import with_once
from dossier.functions.text import host
from dossier.operators.feeds import review_label
from dossier.operators.identity import ratio_udf

#: Words of legal forms that name no company, and words that alone name none.
LEGAL_STOP = ("as", "asa", "sa", "enk", "nuf", "da", "ans", "ba", "stiftelsen", "sameiet", "avd", "avdeling")
GENERIC = ("holding", "eiendom", "invest", "bolig", "service", "drift", "gruppen", "group")
#: Name shares that one and two strong channels need, and the ratio that the company's own domain needs.
ONE_CHANNEL, TWO_CHANNELS, FUZZY = 0.99, 0.66, 0.85
PLACE = ("place_id", "data_id", "link", "title", "address", "phone", "web_site", "latitude", "longitude", "review_count", "review_rating")
REVIEWS = "array<struct<review_id:string,rating:double,text:string,published_at:string,author_url:string,name:string>>"


def tokens(text: Column) -> Column:
    plain = F.translate(F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("æ"), F.lit("ae")), "øå", "oa")
    return F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0))


def name_words(text: Column) -> Column:
    """Words of a name but for legal forms, of three characters or a number."""
    return F.filter(tokens(text), lambda t: ~t.isin(*LEGAL_STOP) & ((F.length(t) >= 3) | t.rlike("^[0-9]+$")))


def phone(text: Column) -> Column:
    """The last eight digits, after the country's 47 where there are more than eight."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9]", "")
    return F.right(F.when(bare.startswith("47") & (F.length(bare) > 8), F.substr(bare, F.lit(3))).otherwise(bare), F.lit(8))


def domain(url: Column) -> Column:
    text = F.trim(F.coalesce(url, F.lit("")))
    return F.when(text == "", "").otherwise(host(F.when(text.contains("://"), text).otherwise(F.concat(F.lit("https://"), text))))


def _known(profiles: DataFrame) -> DataFrame:
    """Profiles as they are compared; ``site`` is the company's own where identity is proved, else null."""
    street, city = tokens(F.col("street")), tokens(F.col("city"))
    return profiles.select("organisation_number", name_words(F.col("name")).alias("t_words"), street.alias("t_street"), F.coalesce("postcode", F.lit("")).alias("t_post"), city.alias("t_city"), phone(F.col("phone")).alias("t_phone"), domain(F.col("site")).alias("t_domain"))


def latest_places(places: DataFrame) -> DataFrame:
    """One row per place (its id, data id, link or content), the last by ``seq``, with a hash of its content."""
    own = places.withColumn("digest", F.sha2(F.to_json(F.struct(*PLACE, "user_reviews")), 256))
    key = F.coalesce(*(F.nullif(c, F.lit("")) for c in ("place_id", "data_id", "link")), "digest")
    keys = ["_place", *(["organisation_number"] if "organisation_number" in places.columns else [])]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("seq").desc()))
    return own.withColumn("_place", key).withColumn("_n", nth).where("_n = 1").drop("_n")


def pairs(profiles: DataFrame, places: DataFrame) -> DataFrame:
    """(organisation_number, _place): pairs that share a key; with a column organisation_number, places of that company only.

    Of a company's keys of address and word those stay that the fewest places have, as many as ``ONE_CHANNEL`` lets a name miss
    and one more: a place that has none of them lacks too much of the name. Words such as "nord", which a street's companies and
    places all have, would else pair them all.
    """
    known = _known(profiles)
    with_word = lambda words, head: F.transform(words, lambda w: F.concat(head, F.lit("|"), w))
    longest = F.element_at(F.array_sort(F.transform("t_street", lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))), -1)["w"]
    near = F.when(F.col("t_post") != "", F.concat(F.lit("z:"), "t_post")).when(F.size("t_street") > 0, F.concat(F.lit("s:"), longest))
    own = F.array_compact(F.array(F.when(F.length("t_phone") >= 5, F.concat(F.lit("p:"), "t_phone")), F.when(F.col("t_domain") != "", F.concat(F.lit("d:"), "t_domain"))))
    proved = known.select("organisation_number", F.explode(own).alias("key"))
    target = F.array_distinct("t_words")
    enough = F.size(target) - F.ceil(F.size(target) * ONE_CHANNEL - 1e-9) + 1
    named = known.select("organisation_number", enough.alias("_enough"), F.explode(F.coalesce(with_word(target, near), F.array().cast("array<string>"))).alias("key"))
    labels = F.split(domain(F.col("web_site")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    address, words = tokens(F.col("address")), name_words(F.col("title"))
    placed = F.flatten(F.transform(F.array_distinct(address), lambda a: F.flatten(F.transform(F.array_distinct(words), lambda w: F.array(F.concat(F.lit("z:"), a, F.lit("|"), w), F.concat(F.lit("s:"), a, F.lit("|"), w))))))
    keys = F.concat(F.array(F.concat(F.lit("p:"), phone(F.col("phone")))), suffixes, placed)
    asked = ["organisation_number"] if "organisation_number" in places.columns else []
    right = places.select("_place", *(F.col(c).alias("_asked") for c in asked), F.explode(F.array_distinct(keys)).alias("key"))
    held = right.groupBy("key").agg(F.count("*").alias("_held"))
    rarest = F.row_number().over(Window.partitionBy("organisation_number").orderBy(F.coalesce("_held", F.lit(0)), "key"))
    named = named.join(held, "key", "left").withColumn("_n", rarest).where("_n <= _enough and _held > 0").select("organisation_number", "key")
    met = proved.unionByName(named).join(right, "key")
    return (met.where("_asked = organisation_number") if asked else met).select("organisation_number", "_place").distinct()


def scored(profiles: DataFrame, places: DataFrame, trade_names: DataFrame) -> DataFrame:
    """Assessment of every pair that shares a key; ``trade_names(organisation_number, trade_name, source)`` are proved elsewhere."""
    latest = latest_places(places)
    asked = "organisation_number" in latest.columns
    found = pairs(profiles, latest).join(_known(profiles), "organisation_number").join(latest.select("_place", *(["organisation_number"] if asked else []), *PLACE), ["_place", *(["organisation_number"] if asked else [])])
    address, words = tokens(F.col("address")), name_words(F.col("title"))
    found = with_once(found, {"c_address": address, "c_words": words, "c_phone": phone(F.col("phone")), "c_domain": domain(F.col("web_site")), "trade_name": F.array_join(tokens(F.col("title")), " ")})
    inside = lambda small, large: F.size(F.array_except(small, large)) == 0
    target = F.array_distinct("t_words")
    share = F.coalesce(F.try_divide(F.size(F.array_intersect("t_words", "c_words")).cast("double"), F.size(target)), F.lit(0.0))
    post = F.array_contains("c_address", F.col("t_post"))
    site = (F.col("t_domain") != "") & ((F.col("c_domain") == F.col("t_domain")) | F.col("c_domain").endswith(F.concat(F.lit("."), "t_domain")))
    found = with_once(found, {
        "name_share": share, "address_match": (F.size("t_street") > 0) & inside("t_street", "c_address") & ((F.col("t_post") == "") | post), "postcode_city_match": (F.col("t_post") != "") & post & inside("t_city", "c_address"),
        "phone_match": (F.length("t_phone") >= 5) & (F.col("t_phone") == F.col("c_phone")), "website_match": site,
    })
    near = found.where("website_match").select("organisation_number", "_place", ratio_udf()(F.array_join("t_words", " "), F.array_join("c_words", " ")).alias("fuzzy"))
    proved = trade_names.select("organisation_number", "trade_name", F.col("source").alias("trade_name_source"))
    found = found.join(near, ["organisation_number", "_place"], "left").join(proved, ["organisation_number", "trade_name"], "left")
    as_int = lambda c: F.col(c).cast("int")
    channels = (F.col("address_match") | F.col("postcode_city_match")).cast("int") + as_int("phone_match") + as_int("website_match")
    trade = (F.col("name_share") == 0) & F.col("address_match") & F.col("phone_match") & F.col("trade_name_source").isNotNull()
    ok = ((F.col("name_share") >= ONE_CHANNEL) & (channels >= 1)) | ((F.col("name_share") >= TWO_CHANNELS) & (channels >= 2)) | trade | (F.col("website_match") & (F.coalesce("fuzzy", F.lit(0.0)) >= FUZZY))
    weak = (F.size(target) == 1) & F.coalesce(F.get(target, F.lit(0)).isin(*GENERIC), F.lit(False)) & ~(F.col("address_match") | F.col("phone_match") | F.col("website_match"))
    points = 4 * F.col("name_share") + 3 * as_int("address_match") + 2 * as_int("phone_match") + 3 * as_int("website_match") + 2 * as_int("postcode_city_match")
    known = F.least(F.lit(1.0), F.log10(F.greatest(F.lit(1), F.coalesce("review_count", F.lit(0)))) / 5)
    return found.withColumns({"trade_name_match": trade, "accepted": ok & ~weak, "score": F.round(points + known, 4)})


def best_places(profiles: DataFrame, assessed: DataFrame) -> DataFrame:
    """(organisation_number, status, candidates, _place, score): the accepted place of highest score; none of two that share it.

    ``candidates`` are the places that were compared with the company, see ``pairs``."""
    order = Window.partitionBy("organisation_number").orderBy(F.col("score").desc(), F.coalesce("data_id", F.lit("")), "_place")
    top = assessed.where("accepted").withColumns({"_n": F.row_number().over(order), "_next": F.lead("score").over(order)}).where("_n = 1")
    top = top.select("organisation_number", (F.col("_next") == F.col("score")).alias("_tie"), "_place", "score")
    held = profiles.select("organisation_number").join(assessed.groupBy("organisation_number").agg(F.count("*").alias("candidates")), "organisation_number", "left").join(top, "organisation_number", "left")
    tie = F.coalesce("_tie", F.lit(False))
    status = F.when(F.col("_place").isNull(), "no_exact_match").when(tie, "ambiguous_exact_match").otherwise("exact_match")
    only = lambda c: F.when(~tie, F.col(c)).alias(c)
    return held.select("organisation_number", status.alias("status"), F.coalesce("candidates", F.lit(0)).alias("candidates"), only("_place"), only("score"))


def observations(best: DataFrame, places: DataFrame, retrieved_at: str) -> DataFrame:
    """Observations of matched places: summary, site, ratings three times, and one per review with a star."""
    asked = ["organisation_number"] if "organisation_number" in places.columns else []
    own = best.where("status = 'exact_match'").join(latest_places(places), ["_place", *asked])
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    span = F.concat(said("title"), F.lit("; "), said("address"), F.lit("; "), said("phone"), F.lit("; rating="), said("review_rating"), F.lit("; reviews="), said("review_count"))
    mark = F.coalesce(F.nullif("place_id", F.lit("")), F.left("digest", F.lit(16)))
    rating, count = F.coalesce("review_rating", F.lit(0.0)), F.coalesce("review_count", F.lit(0)).cast("long")
    text = lambda c: F.lit(c).cast("string")

    def row(ident, signal, source_class, strategy, evidence, with_rating=False, review=None):
        ranked = (rating.alias("rating"), count.alias("review_count")) if with_rating else (F.lit(None).cast("double").alias("rating"), F.lit(None).cast("long").alias("review_count"))
        more = (text(None).alias("reviewer_id"), text(None).alias("published_at"), text(None).alias("sentiment_label"), text(None).alias("sentiment_model_version"))
        if review is not None:
            ranked = (review["rating"].alias("rating"), F.lit(None).cast("long").alias("review_count"))
            writer = F.coalesce(F.nullif(review["author_url"], F.lit("")), F.nullif(review["name"], F.lit("")), F.concat(F.lit("anonymous-"), review["nth"].cast("string")))
            more = (writer.alias("reviewer_id"), review["published_at"].alias("published_at"), review_label(review["rating"]).alias("sentiment_label"), F.lit("explicit_star_rating_v1").alias("sentiment_model_version"))
        return F.struct(ident.alias("id"), F.lit(signal).alias("signal_type"), F.lit(source_class).alias("source_class"), evidence.alias("evidence_span"), F.lit(strategy).alias("strategy"), *ranked, *more)

    ident = lambda kind: F.concat(F.lit(f"places-{kind}-"), "organisation_number", F.lit("-"), mark)
    has_rating = (count > 0) & (rating > 0) & (rating <= 5)
    fixed = F.array(
        row(ident("place"), "place_summary", "public_business_listing", "places_identity_resolution", span), F.when(F.coalesce("web_site", F.lit("")) != "", row(ident("site"), "company_profile", "public_business_listing", "company_site_identity", span)),
        *(F.when(has_rating, row(ident(kind), signal, cls, strategy, span, True)) for kind, signal, cls, strategy in (("review-summary", "review_summary", "customer_review_summary", "places_rating_reviews"), ("profile-metrics", "profile_metrics", "public_business_listing", "social_profile_metrics"), ("buzz", "buzz_metrics", "customer_review_summary", "buzz_peer_normalization"))),
    )
    numbered = F.transform(F.coalesce("user_reviews", F.array().cast(REVIEWS)), lambda r, i: F.struct(*(r[c].alias(c) for c in ("review_id", "rating", "text", "published_at", "author_url", "name")), i.alias("nth")))
    starred = F.filter(numbered, lambda r: (r["rating"] > 0) & (r["rating"] <= 5))
    review_id = lambda r: F.coalesce(F.nullif(r["review_id"], F.lit("")), F.left(F.sha2(F.to_json(r), 256), F.lit(20)))
    evidence = lambda r: F.when(F.trim(F.coalesce(r["text"], F.lit(""))) != "", F.left(F.trim(r["text"]), F.lit(1200))).otherwise(F.concat(F.lit("Explicit customer rating: "), r["rating"].cast("string"), F.lit("/5")))
    reviews = F.transform(starred, lambda r: row(F.concat(F.lit("places-review-"), "organisation_number", F.lit("-"), review_id(r)), "review", "customer_review", "independent_sentiment", evidence(r), review=r))
    common = {"platform": F.lit("google_places"), "source_url": F.coalesce("link", F.lit("")), "retrieved_at": F.lit(retrieved_at), "content_sha256": F.col("digest"), "exact_entity": F.lit(True), "identity_proof_count": F.lit(6), "acquisition_mode": F.lit("unofficial_api_experiment"), "rights_status": F.lit("review_required")}
    return own.select("organisation_number", *(c.alias(k) for k, c in common.items()), F.inline(F.concat(F.array_compact(fixed), reviews)))


# --- bindings -----------------------------------------------------------------------------------------------------------

#: SQL for both engines: companies with addresses, and places in seven forms of agreement with them.
_PROFILES = """select organisation_number, concat(replace(name, ' AS', ''), ' Industri Nord AS') as name, case when k % 9 = 0 then null else concat('Gate ', cast(k % 40 as {S}), ' B') end as street, case when k % 8 = 0 then null else lpad(cast(k % 700 as {S}), 4, '0') end as postcode,
 municipality as city, concat('+47 22 ', lpad(cast(k as {S}), 6, '0')) as phone, case when k % 3 = 0 then concat('https://www.f', cast(k as {S}), '.no/') end as site, k from c"""
_PLACES = """select cast(p_partkey as {S}) as seq_id, case when p_partkey % 17 = 0 then '' else concat('pl', cast(p_partkey % 1900 as {S})) end as place_id, concat('da', cast(p_partkey as {S})) as data_id, concat('https://maps.example/', cast(p_partkey as {S})) as link,
 case v when 0 then base when 1 then concat(base, ' Butikk') when 2 then concat('Industri Nord ', num) when 3 then concat('Industri Nord ', num) when 4 then concat('Custommer ', num, ' Industri Nordd') when 5 then concat('Best Bakery ', translate(num, '0123456789', 'abcdefghij')) else 'Industri Nord' end as title,
 case when v = 2 then 'Elsewhere 1' when v = 1 then concat('Other road 3, ', post, ' ', city) else concat('Gate ', cast(k % 40 as {S}), ' B, ', post, ' ', city) end as address, case when v in (0, 2, 5) then concat('22', lpad(cast(k as {S}), 6, '0')) end as phone,
 case when v in (2, 4) then concat('http://shop.f', cast(k as {S}), '.no/x') when v = 3 then 'other.example' else '' end as web_site, cast(null as double) as latitude, cast(null as double) as longitude, cast(case when k % 10 = 0 then 5 when p_partkey % 13 = 0 then 0 else p_partkey end as bigint) as review_count, cast(p_partkey % 11 as double) / 2 as review_rating, cast(p_partkey as bigint) as seq
from (select p_partkey, k, municipality as city, p_partkey % 7 as v, concat(replace(replace(name, ' AS', ''), '#', ' '), ' Industri Nord') as base, substr(name, 10, 9) as num, lpad(cast(k % 700 as {S}), 4, '0') as post from {part} join c on k = p_partkey * 11 % 149 + 1) x"""
_C = "select *, cast(organisation_number as bigint) - 900000000 as k from {registry}"


def _bound(s, d, text):
    c = s.sql(_C, registry=bind(s, d, "registry"))
    text = text.replace("{S}", "string").replace("from c", "from {c}").replace("join c on", "join {c} on")
    return s.sql(text, c=c, **({"part": bind(s, d, "part")} if "{part}" in text else {}))


def _companies(s, d):
    return _bound(s, d, _PROFILES)


def _places(s, d):
    review = F.struct(F.when(F.col("seq") % 3 == 0, F.concat(F.lit("r"), "seq")).alias("review_id"), (F.col("seq") % 7).cast("double").alias("rating"), F.when(F.col("seq") % 2 == 0, " Good ").alias("text"), F.lit("2026").alias("published_at"), F.lit(None).cast("string").alias("author_url"), F.when(F.col("seq") % 5 != 0, F.concat(F.lit("Name "), "seq")).alias("name"))
    return _bound(s, d, _PLACES).withColumn("user_reviews", F.when(F.col("seq") % 4 != 0, F.array(review)))


def _trade_names(s, d):
    return _companies(s, d).where("k % 2 = 0").select("organisation_number", F.concat(F.lit("best bakery "), F.translate(F.lpad(F.col("k").cast("string"), 9, "0"), "0123456789", "abcdefghij")).alias("trade_name"), F.lit("https://trade.example/").alias("source"))


def _assessed(s, d):
    return scored(_companies(s, d), _places(s, d), _trade_names(s, d))


def _best(s, d):
    return best_places(_companies(s, d), _assessed(s, d))


def _observed(s, d):
    return observations(_best(s, d), _places(s, d), "2026-08-01T00:00:00Z")


_SQL_TOK = lambda x: f"regexp_extract_all(translate(replace(lower(coalesce({x}, '')), 'æ', 'ae'), 'øå', 'oa'), '[a-z0-9]+')"
_SQL_WORDS = lambda x: f"list_filter({_SQL_TOK(x)}, lambda w: w not in {LEGAL_STOP} and (length(w) >= 3 or regexp_full_match(w, '[0-9]+')))"
_SQL_PHONE = lambda x: f"right(case when starts_with(regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g'), '47') and length(regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')) > 8 then regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')[3:] else regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g') end, 8)"
_SQL_DOMAIN = lambda x: f"regexp_replace(lower(regexp_extract(case when contains({x}, '://') then {x} else 'https://' || {x} end, '://([^/?#:]*)', 1)), '^www\\.', '')"
_TEXT = lambda t: t.replace("{S}", "varchar").replace("{part}", "part").replace("{registry}", "registry")
#: All pairs, no index; the one ratio that reaches the limit is that of the title with doubled letters.
_SQL = f"""{ctes("registry")}, c as ({_TEXT(_C)}), profiles as ({_TEXT(_PROFILES)}), raw as ({_TEXT(_PLACES)}),
 latest as (select *, coalesce(nullif(place_id, ''), data_id) as place from raw qualify row_number() over (partition by coalesce(nullif(place_id, ''), data_id) order by seq desc) = 1),
 t as (select organisation_number, k, {_SQL_WORDS("name")} as tw, {_SQL_TOK("street")} as ts, coalesce(postcode, '') as tp, {_SQL_TOK("city")} as tc, {_SQL_PHONE("phone")} as tph, coalesce({_SQL_DOMAIN("site")}, '') as td from profiles),
 l as (select *, {_SQL_WORDS("title")} as cw, {_SQL_TOK("title")} as ct, {_SQL_TOK("address")} as ca, {_SQL_PHONE("phone")} as cph, {_SQL_DOMAIN("web_site")} as cd from latest),
 a as (select organisation_number, k, place, data_id, title, ct, tw, review_count, len(list_intersect(tw, cw)) * 1.0::double / len(list_distinct(tw)) as share, len(ts) > 0 and list_has_all(ca, ts) and (tp = '' or list_contains(ca, tp)) as am, tp <> '' and list_contains(ca, tp) and list_has_all(ca, tc) as pm,
  length(tph) >= 5 and tph = cph as phm, td <> '' and (cd = td or ends_with(cd, '.' || td)) as wm from t, l),
 b as (select *, cast(am or pm as int) + cast(phm as int) + cast(wm as int) as n, share = 0 and am and phm and k % 2 = 0 and array_to_string(ct, ' ') = 'best bakery ' || translate(lpad(cast(k as varchar), 9, '0'), '0123456789', 'abcdefghij') as trade, wm and starts_with(title, 'Custommer ') and title[11:19] = lpad(cast(k as varchar), 9, '0') as fuzzy from a),
 e as (select *, share >= {ONE_CHANNEL} and n >= 1 or share >= {TWO_CHANNELS} and n >= 2 or trade or fuzzy as ok, round(4 * share + 3 * cast(am as int) + 2 * cast(phm as int) + 3 * cast(wm as int) + 2 * cast(pm as int) + least(1.0, log10(greatest(1, review_count)) / 5), 4) as score from b),
 ranked as (select *, row_number() over (partition by organisation_number order by score desc, data_id, place) as i, lead(score) over (partition by organisation_number order by score desc, data_id, place) as next from e where ok),
 best as (select p.organisation_number, case when place is null then 'no_exact_match' when coalesce(next = score, false) then 'ambiguous_exact_match' else 'exact_match' end as status, case when not coalesce(next = score, false) then place end as place, case when not coalesce(next = score, false) then score end as score
  from profiles p left join (select * from ranked where i = 1) r on r.organisation_number = p.organisation_number)"""
_O = f"{_SQL}, o as (select best.organisation_number, latest.*, coalesce(nullif(place_id, ''), 'x') as mark, review_count > 0 and review_rating > 0 and review_rating <= 5 as rated from best join latest on latest.place = best.place where status = 'exact_match')"
_SPAN = "title || '; ' || address || '; ' || coalesce(phone, 'None') || '; rating=' || review_rating || '; reviews=' || review_count"
_OBS = ("organisation_number", "signal_type", "source_class", "strategy", "evidence_span", "source_url", "rating", "review_count", "reviewer_id", "sentiment_label")


def _observed_sql() -> str:
    kinds = [("place_summary", "public_business_listing", "places_identity_resolution", "true", False), ("company_profile", "public_business_listing", "company_site_identity", "web_site <> ''", False), ("review_summary", "customer_review_summary", "places_rating_reviews", "rated", True), ("profile_metrics", "public_business_listing", "social_profile_metrics", "rated", True), ("buzz_metrics", "customer_review_summary", "buzz_peer_normalization", "rated", True)]
    arms = [f"select organisation_number, '{signal}' as signal_type, '{cls}' as source_class, '{strategy}' as strategy, {_SPAN} as evidence_span, link as source_url, {'review_rating' if r else 'cast(null as double)'} as rating, {'review_count' if r else 'cast(null as bigint)'} as review_count, cast(null as varchar) as reviewer_id, cast(null as varchar) as sentiment_label from o where {where}" for signal, cls, strategy, where, r in kinds]
    arms.append("""select organisation_number, 'review', 'customer_review', 'independent_sentiment', case when seq % 2 = 0 then 'Good' else 'Explicit customer rating: ' || cast(seq % 7 as double) || '/5' end, link, cast(seq % 7 as double), null, case when seq % 5 <> 0 then 'Name ' || seq else 'anonymous-0' end,
 case when seq % 7 <= 2 then 'negative' when seq % 7 >= 4 then 'positive' else 'neutral' end from o where seq % 4 <> 0 and seq % 7 between 1 and 5""")
    return f"{_O} " + " union all ".join(arms)


QUERIES = {
    "place_match_best": (lambda s, d: _best(s, d).select("organisation_number", "status", F.col("_place").alias("place"), "score"), f"{_SQL} select organisation_number, status, place, score from best"),
    "place_match_accepted": (lambda s, d: _assessed(s, d).where("accepted").select("organisation_number", F.col("_place").alias("place"), "address_match", "postcode_city_match", "phone_match", "website_match", "trade_name_match", "score"), f"{_SQL} select organisation_number, place, am as address_match, pm as postcode_city_match, phm as phone_match, wm as website_match, trade as trade_name_match, score from e where ok"),
    "place_observations": (lambda s, d: _observed(s, d).select(*_OBS), _observed_sql()),
}
