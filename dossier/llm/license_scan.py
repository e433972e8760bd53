"""License scans through a positional rare-token index; DataFrame functions only.

The index holds, for every word of the licence templates but the most common words of English, the templates and positions
where it stands. A pass over the texts keeps, per file, the positions of the words that the index or a key phrase has.
Document frequencies of these words over all files rank them by IDF. Per file:

* its licence words of high IDF are looked up: a template of which ``COVERED`` tenths of the positions have to be met must
  meet one of the remaining part and one more, so its words of highest IDF, so many positions of them, decide whether the
  file is read for it at all; no template can be lost by that;
* for the templates found, all postings meet all places of the file's words: each says where the template would start, and
  a start counts that two positions of the template agree on. The positions that stand at such starts are united, so
  insertions only cost what they shift; the template is covered where they are ``COVERED`` tenths of its positions or more;
* the template's mandatory key phrases are then verified word by word, apart from that.

A file's places and postings are arrays of one row: numbers made of template, start and position, sorted once, in which
agreeing starts are neighbours. Nothing moves between files but the counts of the vocabulary.

A template that passes adds its label. Key phrases that name a licence label a file by themselves, as do the base phrases.

Null or empty text: no words, no labels, score 0. Repeated rows count as often as they occur; doc_id may be of any type.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.functions.frames import with_once
from dossier.llm.shared import cut, table

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Phrases that name further licences.
OWN = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license": "apache",
}
#: Public licence texts or notices by (label, mandatory key phrases, text).
TEMPLATES = {
    "mit": (
        "mit",
        ["permission is hereby granted free of charge", "the software is provided as is"],
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "isc": (
        "isc",
        ["to use copy modify and or distribute this software"],
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ),
    "bsd-3-clause": (
        "bsd",
        ["redistribution and use in source and binary forms", "neither the name of"],
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    ),
    "bsd-conditions": (
        "bsd",
        ["redistribution and use in source and binary forms", "redistributions of source code must retain"],
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    "zlib": (
        "zlib",
        ["altered source versions must be plainly marked as such"],
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
        is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. This notice may not be removed or altered from any source distribution.""",
    ),
    "apache-notice": (
        "apache",
        ["licensed under the apache license"],
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    "gpl-notice": (
        "gpl",
        ["under the terms of the gnu general public license"],
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program.""",
    ),
    "mpl-notice": (
        "mpl",
        ["subject to the terms of the mozilla public license"],
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    "unlicense": (
        "unlicense",
        ["free and unencumbered software released into the public domain"],
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
        this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for
        the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an
        overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    ),
    "boost": (
        "boost",
        ["obtaining a copy of the software and accompanying documentation"],
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
        transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
        is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement,
        including the above license grant, this restriction and the following disclaimer, must be included in all copies of the
        Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are
        solely in the form of machine-executable object code generated by a source language processor.""",
    ),
}
#: Words of English that are rare in no corpus; the index leaves them out.
COMMON = set("a all an and any are as at be but by can for from if in is it its no not of on or other that the this to was will with without you".split())
#: Tenths of a template's indexed positions that have to be met.
COVERED = 6

PHRASES = BASE | OWN
KEY_PHRASES = list(dict.fromkeys([*PHRASES, *(p for _, phrases, _ in TEMPLATES.values() for p in phrases)]))


def _template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^0-9a-z]+", text.lower()) if w]


#: Rows (word, template, position): the postings of the index.
INDEX = [(w, name, at) for name, (_, _, text) in TEMPLATES.items() for at, w in enumerate(_template_words(text)) if w not in COMMON]
INDEXED = sorted({w for w, _, _ in INDEX})
VOCABULARY = sorted({w for p in KEY_PHRASES for w in p.split()} | set(INDEXED))
NAMES = list(TEMPLATES)
SIZES = {name: sum(x[1] == name for x in INDEX) for name in NAMES}
#: A posting met at a place is one number: template, start (from a place before the text), position.
POSITIONS, STARTS = 1 << 10, 1 << 38
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Lower-cased words. The Kelvin sign is the one character beyond ASCII that ``lower`` would make an ASCII letter."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")))
    return F.split(F.regexp_replace(plain, f"^{_APART}|{_APART}$", ""), _APART, -1)


def postings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, hits): hits are (at, w) of vocabulary words in whole texts."""
    hit = lambda w, i: F.when(w.isin(VOCABULARY), F.struct(i.cast("long").alias("at"), w.alias("w")))
    own = docs.select("doc_id", _words(F.col("text")).alias("w"))
    empty = (F.size("w") == 1) & (F.col("w")[0] == "")
    hits = F.filter(F.transform("w", hit), lambda h: h.isNotNull()).alias("hits")
    return own.select("doc_id", F.when(empty, 0).otherwise(F.size("w")).cast("long").alias("n_words"), hits)


def word_counts(found: DataFrame) -> tuple[int, dict[str, int]]:
    """Files, and files that hold each vocabulary word; the table collected has one row per word of VOCABULARY at most."""
    words = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
    return found.count(), {r["w"]: r["count"] for r in words.groupBy("w").count().collect()}


def _starts(phrase: list[str], df: dict[str, int]) -> Column:
    """Starts of ``phrase``: the shifted places of its rarest word met with those of every other word."""
    rarest = sorted(range(len(phrase)), key=lambda k: (df.get(phrase[k], 0), k))
    at = lambda k: F.transform(F.filter("hits", lambda h: h["w"] == phrase[k]), lambda h: h["at"] - k)
    met = at(rarest[0])
    for k in rarest[1:]:
        met = F.array_intersect(met, at(k))
    present = F.exists("hits", lambda h: h["w"] == phrase[rarest[0]])
    return F.when(present, met).otherwise(F.array().cast("array<bigint>"))


def _needed(name: str) -> int:
    return -(-COVERED * SIZES[name] // 10)


def rare_words(df: dict[str, int]) -> dict[str, list[int]]:
    """Word -> templates (by number) of which it stands at one of the positions of highest IDF; one of these has to be met."""
    found: dict[str, list[int]] = {}
    for number, name in enumerate(NAMES):
        rarest = sorted((w for w, t, _ in INDEX if t == name), key=lambda w: (df.get(w, 0), w))
        for w in sorted(set(rarest[: SIZES[name] - _needed(name) + 1])):
            found.setdefault(w, []).append(number)
    return found


def _lists(of: dict[str, list[int]]) -> Column:
    """The lists of ``of`` by the number of a word in VOCABULARY, from 1, as one literal that the JVM reads."""
    return F.from_json(F.lit(json.dumps([of.get(w, []) for w in VOCABULARY])), "array<array<bigint>>")


def with_templates(found: DataFrame, df: dict[str, int]) -> DataFrame:
    """``found`` with met: numbers template * POSITIONS + position, of all positions that stand at starts two agree on."""
    postings_of: dict[str, list[int]] = {}
    for w, name, pos in INDEX:
        postings_of.setdefault(w, []).append((NAMES.index(name) * STARTS + POSITIONS - pos) * POSITIONS + pos)
    rare = rare_words(df)
    looked_up = F.filter("hits", lambda h: h["w"].isin(sorted(rare)))
    number = lambda w: F.array_position(F.array(*map(F.lit, VOCABULARY)), w).cast("int")
    lists = with_once(found, {"_rare": _lists(rare), "_postings": _lists(postings_of)})
    here = with_once(lists, {"_templates": F.array_distinct(F.flatten(F.transform(looked_up, lambda h: F.element_at("_rare", number(h["w"])))))})
    none = F.array().cast("array<bigint>")
    of_template = lambda code: F.floor(code / (STARTS * POSITIONS))
    at_place = lambda h: F.transform(F.filter(F.element_at("_postings", number(h["w"])), lambda a: F.array_contains("_templates", of_template(a))), lambda a: a + h["at"] * POSITIONS)
    codes = F.array_sort(F.flatten(F.transform(F.filter("hits", lambda h: h["w"].isin(INDEXED)), at_place)))
    met = with_once(here, {"_codes": F.when(F.size("_templates") > 0, codes).otherwise(none)})
    start = lambda code: F.shiftright(code, 10)
    same = lambda a, b: F.coalesce(start(a) == start(b), F.lit(False))
    agreed = F.filter("_codes", lambda c, i: same(c, F.get("_codes", i - 1)) | same(c, F.get("_codes", i + 1)))
    positions = F.array_distinct(F.transform(agreed, lambda c: F.shiftright(c, 48) * POSITIONS + c.bitwiseAND(F.lit(POSITIONS - 1))))
    return with_once(met, {"met": positions}).drop("_rare", "_postings", "_templates", "_codes")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, templates, score; one row per file.

    score: the greater of s / (s + 10), s the IDF, ln(1 + files / files with the word), of the words of every distinct
    phrase found, and of the cover of the file's templates; 0 without either.
    """
    found = cut(postings(docs), "licence-postings")
    n, df = word_counts(found)
    starts = {p: f"_s{i}" for i, p in enumerate(KEY_PHRASES)}
    known = with_once(with_templates(found, df), {c: _starts(p.split(), df) for p, c in starts.items()})
    has = lambda p: F.size(starts[p]) > 0
    base = F.concat(*(F.col(starts[p]) for p in BASE))
    times = {name: F.size(F.filter("met", lambda m: F.shiftright(m, 10) == i)) for i, name in enumerate(NAMES)}  # noqa: B023
    known = with_once(known, {f"_c{i}": F.when(10 * c >= COVERED * SIZES[name], c / SIZES[name]) for i, (name, c) in enumerate(times.items())})
    cover = F.greatest(*(F.col(f"_c{i}") for i in range(len(NAMES))))
    verified = {name: F.col(f"_c{i}").isNotNull() for i, name in enumerate(NAMES)}
    for name, (_, phrases, _) in TEMPLATES.items():
        for p in phrases:
            verified[name] = verified[name] & has(p)
    join = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")
    named = [F.when(has(p), F.lit(label)) for p, label in PHRASES.items()]
    own = [F.when(verified[name], F.lit(label)) for name, (label, _, _) in TEMPLATES.items()]
    idf = {w: math.log(1 + n / d) for w, d in df.items()}
    mass = {p: sum(idf[w] for w in p.split()) for p in PHRASES if all(w in idf for w in p.split())}
    s = sum((F.when(has(p), F.lit(m)).otherwise(F.lit(0.0)) for p, m in mass.items()), F.lit(0.0))
    any_template = sum((F.when(v, 1).otherwise(0) for v in verified.values()), F.lit(0)) > 0
    return known.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base).cast("long").alias("first_word"),
        F.array_max(base).cast("long").alias("last_word"),
        join([F.when(has(p), F.lit(label)) for p, label in BASE.items()]).alias("base_labels"),
        join(named + own).alias("labels"),
        join([F.when(v, F.lit(name)) for name, v in verified.items()]).alias("templates"),
        F.round(F.greatest(s / (s + 10.0), F.when(any_template, cover).otherwise(0.0)), 6).alias("score"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    rows = lambda values: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in v) + ")" for v in values)
    phrases = rows((p, PHRASES.get(p, ""), p in BASE, p in PHRASES, len(p.split())) for p in KEY_PHRASES)
    spread = rows((p, w) for p in PHRASES for w in p.split())
    longest = max(len(p.split()) for p in KEY_PHRASES)
    leads = ", ".join(f"lead(w, {k}) over o as w{k}" for k in range(1, longest))
    tests = " or ".join(f"(p.n = {n} and p.phrase = concat_ws(' ', {', '.join(['w', *(f'w{k}' for k in range(1, n))])}))" for n in range(2, longest + 1))
    return rf"""
with phrases(phrase, label, base, named, n) as (values {phrases}), spread(phrase, w) as (values {spread}),
idx(w, template, pos) as (values {rows(INDEX)}),
templates(template, label) as (values {rows((name, label) for name, (label, _, _) in TEMPLATES.items())}),
mandatory(template, phrase) as (values {rows((name, p) for name, (_, own, _) in TEMPLATES.items() for p in own)}),
d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
words as (select doc_id, unnest(ws) as w, unnest(range(0, len(ws))) as pos from d),
near as (select doc_id, pos, w, {leads} from words window o as (partition by doc_id order by pos)),
df as (select w, count(distinct doc_id) as n from words where w in ({quoted(VOCABULARY)}) group by w),
mass as (select phrase, sum(ln(1 + (select count(*) from d) / df.n)) as m from spread join df using (w) group by phrase having count(*) = (select count(*) from spread s where s.phrase = spread.phrase)),
places as (select near.doc_id, near.pos, p.phrase, p.label, p.base, p.named from near join phrases p on p.phrase[1] = near.w[1] and ({tests})),
held as (select doc_id, pos as place, w from words where w in (select w from idx)),
candidates as (select doc_id, template, place - idx.pos as start from held join idx using (w) group by 1, 2, 3 having count(*) >= 2),
met as (select doc_id, template, count(distinct idx.pos) as met from candidates join idx using (template) join held using (doc_id, w) where held.place = start + idx.pos group by 1, 2),
covers as (select doc_id, template, met / size as cover from met join (select template, count(*) as size from idx group by 1) using (template) where 10 * met >= {COVERED} * size),
verified as (select c.doc_id, c.template, label from covers c join templates using (template)
    where not exists (from mandatory m where m.template = c.template and not exists (from places p where p.doc_id = c.doc_id and p.phrase = m.phrase))),
sums as (select doc_id, sum(m) as s from (select distinct doc_id, phrase from places) join mass using (phrase) group by doc_id),
labelled as (select doc_id, label from places where named union select doc_id, label from verified),
agg as (select doc_id, count(*) filter (where base) as n_base, min(pos) filter (where base) as f, max(pos) filter (where base) as l,
    string_agg(distinct label, ',' order by label) filter (where base) as b from places group by doc_id),
names as (select doc_id, string_agg(distinct label, ',' order by label) as a from labelled group by doc_id),
kinds as (select doc_id, string_agg(template, ',' order by template) as t, (select max(cover) from covers c where c.doc_id = verified.doc_id) as cover from verified group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(f as bigint) as first_word, cast(l as bigint) as last_word,
    coalesce(b, '') as base_labels, coalesce(a, '') as labels, coalesce(t, '') as templates, round(greatest(coalesce(s / (s + 10.0), 0.0), coalesce(cover, 0.0)), 6) as score
from d left join agg using (doc_id) left join names using (doc_id) left join kinds using (doc_id) left join sums using (doc_id)
"""


OP4_SQL = _sql()
