"""Licence notices: Dice coefficient over word bigrams between parts of a text and templates.

A text's parts are its sentences and, where a paragraph has several, its paragraphs. Runs of
consecutive lines are compared too, as a wrapped notice may be part of a paragraph or span several;
the SQL has sentences and paragraphs only. Parts and
templates are normalised (lower case, runs without letters or digits become one space) and compared
as sets of word bigrams. A part can reach the threshold only with a template whose number of
bigrams lies within fixed bounds of its own; only those are compared. Texts without any of the
words that a match must contain (derived from the templates) are passed over; no match is lost.

Built-in expressions within a row only: nothing is shuffled. Null and empty texts give no row;
repeated rows give their rows again; templates of equal Dice go to the licence that sorts first.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import narrowed, once

LEAST = 0.8
#: Words of at most so many letters are looked for as whole words.
SHORT = 4

# Customary wording of licence notices, and whole paragraphs of licences.
WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'


def gnu(program: str, license: str, version: str, adjective: str, link: str) -> tuple[str, ...]:
    """The paragraphs of a notice of the GNU licences."""
    either = f"either version {version} of the License, or (at your option) any later version."
    return (
        f"This work is licensed under the GNU {license}, version {version}.",
        f"{program} is free software{link} you can redistribute it and/or modify it under the terms of the GNU {license} as published by the Free Software Foundation{';' if link == ';' else ','} {either}",
        f"{program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license} for more details.",
        f"You should have received a copy of the GNU {license} along with {adjective} program; if not, see <https://www.gnu.org/licenses/>.",
        f"You should have received a copy of the GNU {license} along with {adjective} program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    )


def creative(names: str, version: str) -> tuple[str, ...]:
    return (
        f"This work is licensed under a Creative Commons {names} {version} International License.",
        f"This work is licensed under the Creative Commons {names} {version} International License. To view a copy of this license, visit http://creativecommons.org/licenses/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
    )


TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": gnu("This program", "Affero General Public License", "3", "this", ":"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "BSD-2-Clause": (f"{BSD_GRANT}: 1. {BSD_SOURCE} 2. {BSD_BINARY}",),
    "BSD-3-Clause": ("Released under the BSD License.", BSD_GRANT, BSD_SOURCE, BSD_BINARY, BSD_NAMES, BSD_WARRANTY, f"{BSD_GRANT}: 1. {BSD_SOURCE} 2. {BSD_BINARY} 3. {BSD_NAMES}"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", *creative("Attribution", "4.0")),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", *creative("Attribution-NonCommercial", "4.0")),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.", *creative("Attribution-NonCommercial-NoDerivatives", "4.0")),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", *creative("Attribution-NonCommercial-ShareAlike", "4.0")),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", *creative("Attribution-NoDerivatives", "4.0")),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", *creative("Attribution-ShareAlike", "4.0")),
    "GPL-2.0": gnu("This program", "General Public License", "2", "this", ";"),
    "GPL-3.0": gnu("This program", "General Public License", "3", "this", ":"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "LGPL-2.1": gnu("This library", "Lesser General Public License", "2.1", "this", ";"),
    "LGPL-3.0": gnu("This library", "Lesser General Public License", "3", "this", ":"),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "The MIT License (MIT)",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        WARRANTY,
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}


#: Words that say little, taken last as signs of a notice.
COMMON = frozenset("a and any are by can following for from in is it more not of or permitted person that the this to under use with without work you".split())


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def needed(count: int, least: float) -> int:
    """Shared bigrams without which a template of ``count`` cannot reach ``least``."""
    return math.ceil(least * count / (2 - least) - 1e-9)


def anchors(templates: dict[str, tuple[str, ...]], least: float) -> list[str]:
    """Words such that every part that matches a template contains one of them.

    A match shares ``needed`` bigrams; words that touch more of a template's bigrams than may be
    missing cannot all be absent. Longer words are taken first, being rarer, and common ones last.
    """
    chosen: set[str] = set()
    for texts in templates.values():
        for text in texts:
            grams = bigrams_of(text)
            spare = len(grams) - needed(len(grams), least)
            left = sorted(set(words_of(text)), key=lambda w: (w not in chosen, w in COMMON, -len(w), w))
            own: set[str] = set()
            while sum(bool(own & set(g.split())) for g in grams) <= spare:
                own.add(left.pop(0))
            chosen |= own
    long = {w for w in chosen if len(w) > SHORT}
    return sorted(w for w in chosen if w not in long or not any(v != w and v in w for v in long))


def may_match(text: Column, templates: dict[str, tuple[str, ...]], least: float) -> Column:
    """A cheap test that every text with a match passes."""
    words = anchors(templates, least)
    tests = [F.contains(text, F.lit(w)) for w in words if len(w) > SHORT]
    if short := [w for w in words if len(w) <= SHORT]:
        tests.append(text.rlike(rf"(?<![a-z0-9])(?:{'|'.join(short)})(?![a-z0-9])"))
    return reduce(Column.__or__, tests, F.lit(False))


def words(part: Column) -> Column:
    return F.filter(F.split(F.lower(part), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def paired(words: Column) -> Column:
    """Each word with the next."""
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b))


def bigrams(part: Column) -> Column:
    """The distinct word bigrams of a text."""
    return F.array_distinct(paired(words(part)))


def parts(text: Column) -> Column:
    """Sentences, and paragraphs of several sentences: array of struct<unit, place, text>."""
    sentences = lambda t: F.split(F.regexp_replace(t, r"([.!?]) +", "$1\n"), "\n")
    numbered = lambda unit, items: F.transform(items, lambda t, i: F.struct(F.lit(unit).alias("unit"), i.cast("long").alias("place"), t.alias("text")))
    paragraphs = F.filter(numbered("paragraph", F.split(text, r"\n[ \t]*\n")), lambda p: F.size(sentences(p["text"])) > 1)
    return F.concat(numbered("sentence", sentences(text)), paragraphs)


def worded_lines(text: Column) -> Column:
    """Lines that have words: array of struct<para, line, text, words>; paragraphs and lines count from 0."""
    paragraphs = F.transform(F.split(text, r"\n[ \t]*\n"), lambda p, k: F.transform(F.split(p, "\n"), lambda t: F.struct(k.alias("para"), t.alias("text"))))
    # what parts two paragraphs is one line
    numbered = F.transform(F.flatten(paragraphs), lambda t, k: F.struct(t["para"].alias("para"), (k + t["para"]).cast("long").alias("line"), t["text"].alias("text"), words(t["text"]).alias("words")))
    return F.filter(numbered, lambda t: F.size(t["words"]) > 0)


def line_runs(low: DataFrame, text: str, templates: dict[str, tuple[str, ...]], least: float, keep: tuple[str, ...]) -> DataFrame:
    """Rows of unit ``lines`` for runs of consecutive lines, blank ones between them aside, that are no sentence or paragraph.

    A run is compared with templates of a number of words within the bounds of its own. Runs and
    sentences compete for lines, the one of the highest Dice first; of equal ones a sentence, then the shorter run.
    """
    wide = lambda n: math.floor(n * (2 - least) / least + 1e-9)
    listed = [(name, bigrams_of(t), len(words_of(t)) - 1) for name, texts in sorted(templates.items()) for t in texts]
    known = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(needed(len(grams), least)).alias("low"), F.lit(wide(n)).alias("high")) for name, grams, n in listed])
    every = F.array(*map(F.lit, sorted({g for _, grams, _ in listed for g in grams})))
    rows = once(low.select(*keep, F.col(text).alias("own")), "lines", worded_lines(F.col("own"))).select(*keep, "lines")
    rows = once(rows, "words", F.flatten(F.transform("lines", lambda t: t["words"])))
    rows = once(rows, "grams", F.when(F.size("words") > 1, paired(F.col("words"))).otherwise(F.array().cast("array<string>")))
    rows = once(rows, "shared", F.array_intersect("grams", every))
    rows = once(rows, "fit", F.filter(known, lambda t: F.size(F.array_intersect(F.col("shared"), t["grams"])) >= t["low"])).where(F.size("fit") > 0)
    at = F.flatten(F.transform("lines", lambda t, k: F.transform(t["words"], lambda _: k)))
    rows = once(rows, "at", at)
    starts = F.filter(F.transform("at", lambda k, p: F.when((p == 0) | (k != F.get("at", p - 1)), p)), lambda p: p.isNotNull())
    rows = once(rows, "starts", F.array_append(starts, F.size("words")))
    start = lambda k: F.get("starts", k)
    # bigrams of lines i to j, where wanted with those that cross to the lines around them
    inside = lambda i, j: F.slice(F.col("grams"), start(i) + 1, F.greatest(start(j + 1) - start(i) - 1, F.lit(0)))
    around = lambda i: F.slice(F.col("grams"), F.greatest(start(i), F.lit(1)), start(i + 1) - start(i) + 1)

    def dice(grams: Column, t: Column) -> Column:
        own = F.array_distinct(grams)
        return F.lit(2.0) * F.size(F.array_intersect(own, t["grams"])) / (F.size(own) + F.size(t["grams"]))

    def named(minus: Column, sentence: bool, i: Column, j: Column, t: Column) -> Column:
        return F.struct(minus.alias("minus"), F.lit(0 if sentence else 1).alias("later"), (j - i).alias("more"), i.alias("i"), j.alias("j"), t["license"].alias("license"))

    def of(t: Column) -> Column:
        touched = F.filter(F.transform("lines", lambda _, k: k), lambda k: F.arrays_overlap(around(k), t["grams"]))

        def ends(i: Column, k: Column) -> Column:
            near = F.filter(F.slice(touched, k + 1, t["high"] + 1), lambda j: (start(j + 1) - start(i) - 1).between(t["low"], t["high"]))
            return F.transform(near, lambda j: named(-dice(inside(i, j), t), False, i, j, t))

        def sentences(i: Column) -> Column:
            return F.transform(F.split(F.get("lines", i)["text"], r"(?<=[.!?]) +"), lambda part: named(-dice(bigrams(part), t), True, i, i, t))

        return F.concat(F.flatten(F.transform(touched, ends)), F.flatten(F.transform(touched, sentences)))

    rows = once(rows, "found", F.array_sort(F.filter(F.flatten(F.transform("fit", of)), lambda x: x["minus"] <= -least + 1e-9))).where(F.size("found") > 0)
    kind = rows.schema["found"].dataType.simpleString()
    free = lambda taken, x: ~F.exists(taken, lambda y: (x["i"] <= y["j"]) & (y["i"] <= x["j"]))
    won = F.aggregate("found", F.array().cast(kind), lambda taken, x: F.when(free(taken, x), F.array_append(taken, x)).otherwise(taken))
    para = lambda k: F.get("lines", k)["para"]

    def is_part(x: Column) -> Column:
        single = (x["i"] == x["j"]) & ~F.get("lines", x["i"])["text"].rlike(r"[.!?] ")
        opens = (x["i"] == 0) | (para(x["i"] - 1) != para(x["i"]))
        closes = F.coalesce(para(x["j"] + 1) != para(x["j"]), F.lit(True))
        return (x["later"] == 0) | single | (opens & closes & (para(x["i"]) == para(x["j"])))

    each = rows.select(*keep, "lines", F.explode(F.filter(won, lambda x: ~is_part(x))).alias("x"))
    return each.select(*keep, F.lit("lines").alias("unit"), F.get("lines", F.col("x.i"))["line"].alias("place"), F.col("x.license").alias("license"), F.round(-F.col("x.minus"), 6).alias("dice"))


def scan(df: DataFrame, text: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each part and run of lines that a template matches: ``keep``, unit, place, license, dice."""
    known = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, bigrams_of(t))).alias("grams"), F.lit(len(bigrams_of(t))).alias("n")) for name, texts in sorted(templates.items()) for t in texts])
    low = once(narrowed(df, *keep, text), "low", F.lower(F.col(text))).where(may_match(F.col("low"), templates, least))
    # most parts of such a text still lack those words
    some = F.filter(parts(F.col(text)), lambda p: may_match(F.lower(p["text"]), templates, least))
    each = low.select(*keep, F.explode_outer(some).alias("part")).where(F.col("part").isNotNull())
    each = once(each, "grams", bigrams(F.col("part.text"))).select(*keep, "part.unit", "part.place", "grams", F.size("grams").alias("n"))
    sizes = [len(bigrams_of(t)) for texts in templates.values() for t in texts]
    each = each.where(F.col("n").between(needed(min(sizes), least), math.floor(max(sizes) * (2 - least) / least + 1e-9)))
    fits = F.filter(known, lambda t: (F.col("n") >= least * t["n"] / (2 - least) - 1e-9) & (F.col("n") <= t["n"] * (2 - least) / least + 1e-9))
    dice = lambda t: F.lit(2.0) * F.size(F.array_intersect("grams", t["grams"])) / (F.col("n") + t["n"])
    scored = F.transform(fits, lambda t: F.struct((-dice(t)).alias("minus"), t["license"].alias("license")))
    best = once(each, "best", F.array_min(scored)).where(-F.col("best.minus") >= least - 1e-9)
    out = best.select(*keep, "unit", "place", F.col("best.license").alias("license"), F.round(-F.col("best.minus"), 6).alias("dice"))
    return out.unionByName(line_runs(low, text, templates, least, keep))


def sql(table: str = "documents", templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST) -> str:
    """The rows of sentences and paragraphs in SQL, comparing every part with every template."""
    rows = ", ".join(f"('{name}', {bigrams_of(t)!r})" for name, texts in sorted(templates.items()) for t in texts)
    return f"""
WITH known(license, grams) AS (VALUES {rows}),
split AS (
  SELECT doc_id, 'sentence' AS unit, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(10), 'g'), chr(10)) AS items FROM {table}
  UNION ALL
  SELECT doc_id, 'paragraph', string_split_regex(text, '\\n[ \\t]*\\n') FROM {table}
),
parts AS (
  SELECT doc_id, unit, unnest(range(len(items))) AS place, unnest(items) AS part FROM split
),
worded AS (
  SELECT doc_id, unit, place, list_filter(string_split_regex(lower(part), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words FROM parts
  WHERE unit = 'sentence' OR regexp_matches(part, '[.!?] |\\n')
),
graded AS (
  SELECT doc_id, unit, place, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams
  FROM worded WHERE len(words) BETWEEN 2 AND 400
),
scored AS (
  SELECT doc_id, unit, place, license, 2.0 * len(list_intersect(g.grams, k.grams)) / (len(g.grams) + len(k.grams)) AS dice
  FROM graded g JOIN known k ON len(list_intersect(g.grams, k.grams)) > 0
)
SELECT doc_id, unit, place, license, round(dice, 6) AS dice FROM scored WHERE dice >= {least} - 1e-9
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, place ORDER BY dice DESC, license) = 1
"""
