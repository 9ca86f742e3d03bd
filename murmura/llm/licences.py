"""Licence scans with DataFrame functions only.

Texts are normalised to words of letters and digits and compared to licence templates by the Dice coefficient over
distinct word bigrams: each line, the text as a whole, and every run of as many words as the template has, so that a
notice is found wherever it stands, wrapped or not. Sets of sizes a and b with c in common have a coefficient of t or more
only if c >= b t / (2 - t): so of a template's bigrams any b - c + 1 must hold one that the text has. The rarest (longest)
are these anchors: texts without an anchor's words are left out before anything is split, and a text meets only templates
of which it has an anchor, in an equi-join. Bounds of size prune what is left before coefficients are worked out.
"""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
SLACK = 1e-6

# Notices and texts of public licences.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0.", "Licensed under CC0 1.0 Universal."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
}

#: Words that tell nothing of a text.
COMMON = frozenset("a all an and any are as at be by do for from has have if in is it not of on or shall that the this to under was will with without you".split())

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    """Words of a-z and 0-9 of a text in lower case."""
    return F.filter(F.split(text, "[^a-z0-9]+"), lambda x: x != "")


def lower(text):
    return F.translate(text, _UPPER, _LOWER)


def pairs(w):
    """The pairs of neighbouring words; w must be a column or a lambda's variable, as it is used more than once."""
    last = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, 1, last), F.slice(w, 2, last), lambda x, y: F.concat(x, F.lit(" "), y))


def bound(value, use):
    """use(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


class Template:
    """A template's words and bigrams, and how many of these tell it: a text above the threshold has one of any so many."""

    def __init__(self, licence: str, number: int, text: str, threshold: float) -> None:
        own = [w for w in re.split("[^a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER))) if w]
        self.licence, self.number, self.words = licence, number, len(own)
        self.bigrams = list(dict.fromkeys(f"{a} {b}" for a, b in zip(own, own[1:])))
        size = len(self.bigrams)
        self.telling = size - max(1, -int(-(size * threshold / (2 - threshold) - SLACK) // 1)) + 1
        self.anchors: list[str] = []


def templates(threshold: float = THRESHOLD, texts: dict[str, list[str]] | None = None) -> tuple[list[Template], list[str]]:
    """Every template of two words or more, with its anchors, and words such that each anchor has one of them.

    The words are few and long: one after the other is taken that gives templates most of the anchors they still need,
    common words and those of four letters or fewer only where no other is left."""
    found = [Template(licence, i, t, threshold) for licence, ts in (texts or TEMPLATES).items() for i, t in enumerate(ts)]
    found = [t for t in found if t.bigrams]
    by_word = [{w: [b for b in t.bigrams if w in b.split()] for b in t.bigrams for w in b.split()} for t in found]
    chosen: list[str] = []
    while any(len(t.anchors) < t.telling for t in found):
        gain: dict[str, int] = {}
        for t, held in zip(found, by_word):
            left = t.telling - len(t.anchors)
            for w, bs in held.items() if left else ():
                gain[w] = gain.get(w, 0) + min(left, sum(b not in t.anchors for b in bs))
        word = min((w for w in gain if gain[w]), key=lambda w: (w in COMMON, len(w) <= 4, -gain[w], -len(w), w))
        chosen.append(word)
        for t, held in zip(found, by_word):
            new = [b for b in held.get(word, []) if b not in t.anchors]
            t.anchors += new[: t.telling - len(t.anchors)]
    return found, chosen


def _has(word: str, text: Column, wide: Column) -> Column:
    """Whether the text may have the word; short ones are looked for between other characters. wide: the text in lower case.

    Letters beyond ASCII may become others in wide than in lower(); those of ASCII become the same, so nothing is lost."""
    return wide.contains(word) if len(word) > 4 else text.rlike(f"(?i)(?<![a-z0-9]){word}(?![a-z0-9])")


def _dice(common, n, size):
    return 2 * common / (n + size)


def scan(docs: DataFrame, threshold: float = THRESHOLD, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, unit, place, licence, template, n_bigrams, common, dice.

    A row for each unit and template of a coefficient of the threshold or more. Units are 'line' (place: its number from
    0), 'text' (the whole text, if it has several lines; place 0) and 'words' (as many words as the template has; place:
    the number of the first). Of runs of words that overlap only the one of the highest coefficient counts, the first of
    equals. A null or empty text, and one of fewer than two words, has no bigrams and no rows; a null doc_id is carried
    along; repeated rows are scanned each. Other columns are ignored. The templates are a parameter of fixed size, so
    they are broadcast."""
    known, tell = templates(threshold, texts)
    if not known:
        raise ValueError("no template has two words")
    ratio = (2 - threshold) / threshold
    spark = docs.sparkSession
    anchors = sorted({a for t in known for a in t.anchors})
    table = spark.createDataFrame(
        [(a, t.licence, t.number, t.words, t.bigrams, t.anchors) for t in known for a in t.anchors],
        "anchor string, licence string, template int, words int, bigrams array<string>, anchors array<string>")
    some = docs.where(bound(F.lower("text"), lambda wide: reduce(lambda a, b: a | b, (_has(w, F.col("text"), wide) for w in tell)))).select(
        "doc_id", F.transform(F.split(lower(F.col("text")), "\n"), words).alias("parts"))
    split = some.select("doc_id", "parts", bound(F.flatten("parts"), pairs).alias("b")).withColumn("have", F.array_intersect("b", F.lit(anchors)))
    # explode() and == would add filters for nulls that work arrays out a second time below; here the join drops nulls.
    met = split.select("doc_id", "parts", "b", "have", F.explode_outer("have").alias("anchor")).join(F.broadcast(table), "anchor")
    met = met.where(F.col("anchor").eqNullSafe(F.get(F.array_intersect("have", "anchors"), 0))).withColumn("size", F.size("bigrams"))

    def judged(unit: str, place: Column, own: Column) -> Column:
        """The unit, with nothing in common if its bigrams are too few or too many to reach the threshold."""
        def told(b):
            fits = (F.size(b) * ratio + SLACK >= F.col("size")) & (F.size(b) <= F.col("size") * ratio + SLACK)
            common = F.when(fits, F.size(F.array_intersect(b, F.col("bigrams")))).otherwise(0)
            return F.struct(F.lit(unit).alias("unit"), place.cast("int").alias("place"), F.size(b).alias("n_bigrams"), common.alias("common"))

        return bound(own, told)

    def good(units):
        return F.transform(F.filter(units, lambda u: _dice(u["common"], u["n_bigrams"], F.col("size")) >= threshold), lambda u: F.struct(
            u["unit"], u["place"], u["n_bigrams"], u["common"], _dice(u["common"], u["n_bigrams"], F.col("size")).alias("dice")))

    # A line of fewer words can't have the bigrams, and needn't be looked at.
    long = F.filter(F.transform("parts", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda p: F.size(p["w"]) * ratio >= F.col("size"))
    lines = good(F.transform(long, lambda p: judged("line", p["i"], F.array_distinct(pairs(p["w"])))))
    whole = good(F.when(F.size("parts") > 1, F.array(judged("text", F.lit(0), F.array_distinct("b")))))
    run, last = F.col("words") - 1, F.size("b") - F.col("words") + 1
    at = F.filter(F.transform("b", lambda x, i: F.when(F.array_contains("anchors", x), i)), lambda i: i.isNotNull())
    begins = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(F.greatest(F.lit(0), p - run + 1), F.least(p, last)))))
    runs = good(F.transform(F.when(last >= 0, begins), lambda i: judged("words", i, F.array_distinct(F.slice("b", i + 1, run)))))

    def best(us):
        return F.filter(us, lambda u: ~F.exists(us, lambda v: (F.abs(v["place"] - u["place"]) < F.col("words")) & (
            (v["dice"] > u["dice"]) | ((v["dice"] == u["dice"]) & (v["place"] < u["place"])))))

    every = F.array_compact(F.array(lines, whole, bound(runs, best)))
    return met.select("doc_id", "licence", "template", F.explode_outer(F.flatten(every)).alias("u")).where("u is not null").select(
        "doc_id", "u.unit", "u.place", "licence", "template", "u.n_bigrams", "u.common", "u.dice")


def scan_sql(threshold: float = THRESHOLD) -> str:
    """The same in SQL for DuckDB: texts meet all templates with which they have enough bigrams in common."""
    rows = ", ".join(
        "(" + ", ".join(("'" + x.replace("'", "''") + "'") if isinstance(x, str) else str(x) for x in (licence, i, t)) + ")"
        for licence, ts in TEMPLATES.items() for i, t in enumerate(ts))
    norm = f"string_split(trim(regexp_replace(translate({{}}, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ')"
    both = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    dice = "2.0::double * k / (n + m)"
    return f"""
with t as (select licence, template, len(w) as size, list_distinct({both}) as g from (select licence, template, {norm.format('x')} as w from (values {rows}) v(licence, template, x)) where len(w) > 1),
d as (select row_number() over () as rid, doc_id, text from documents where text is not null),
b as (select rid, {both} as b from (select rid, {norm.format('text')} as w from d) where len(w) > 1),
c as (select * from b, t where list_has_any(b, g) and len(list_intersect(list_distinct(b), g)) + 1e-6 >= len(g) * {threshold} / (2 - {threshold})),
l as (select rid, i - 1 as place, list_distinct({both}) as s from (select rid, i, {norm.format('ls[i]')} as w from (select rid, ls, unnest(range(1, len(ls) + 1)) as i from (select rid, string_split(text, chr(10)) as ls from d))) where len(w) > 1),
u as (select 'line' as unit, place, licence, template, size, s, g, rid from c join l using (rid)
      union all select 'text', 0, licence, template, size, list_distinct(b), g, rid from c join d using (rid) where contains(text, chr(10))
      union all select 'words', i, licence, template, size, list_distinct(b[i + 1 : i + size - 1]), g, rid from (select *, unnest(range(0, len(b) - size + 2)) as i from c)),
n as (select *, {dice} as dice from (select *, len(s) as n, len(g) as m, len(list_intersect(s, g)) as k from u) where {dice} >= {threshold}),
r as (select * from n as x where unit <> 'words' or not exists (select 1 from n as y where y.unit = 'words' and y.rid = x.rid and y.licence = x.licence and y.template = x.template
  and abs(y.place - x.place) < x.size and (y.dice > x.dice or (y.dice = x.dice and y.place < x.place))))
select doc_id, unit, cast(place as integer) as place, licence, template, cast(n as integer) as n_bigrams, cast(k as integer) as common, dice from r join d using (rid)"""


def op6_licences(spark, sf_dir: str) -> DataFrame:
    """Licence notices of all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
