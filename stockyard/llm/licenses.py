"""Licence scans in DataFrame operations only: lines, whole texts and windows of words against licence
templates by the Dice coefficient over word bigrams.

Dice(a, b) = 2 |a & b| / (|a| + |b|) can reach t only if the smaller set has at least
t / (2 - t) of the larger one's size, so a template is compared only with passages in its
size window, and passages outside every window are dropped before their bigrams are made.
The same bound leaves few of a template's bigrams that a match can lack; a text or line with none
of the words that touch more than those is dropped before its words are split.

A window is as long as its template and starts at one of the template's bigrams, so that a notice wrapped
over lines or inside a longer line is found.  Bigrams meet the templates' in one broadcast join; only texts
that hold enough of a template's bigrams are cut into lines and windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import col, materialise

# The short licence texts, by paragraph.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
)
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."

# Notices that name a licence, texts and their usual first lines, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", _MIT[0]),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MIT", "of this software and associated documentation files (the \"Software\"), to deal"),
    ("MIT", " ".join(_MIT)),
    ("MIT", " ".join(("MIT License", *_MIT))),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without"),
    ("BSD-3-Clause", "modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", " ".join((*_BSD, _BSD_END))),
    ("BSD-3-Clause", " ".join((*_BSD, _BSD_NAMES, _BSD_END))),
    ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("Apache-2.0", _APACHE),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "This file is licensed under the MIT license."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "SPDX-License-Identifier: ISC"),
)
THRESHOLD = 0.8
#: Templates of fewer words are not looked for inside lines: two or three words are found in any prose.
WINDOW_WORDS = 5


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits, lower-cased."""
    return F.split(F.trim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " "))), " ")


def bigrams(w: Column) -> Column:
    """Distinct word bigrams of an array of at least two words."""
    return F.array_distinct(F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b)))


def _once(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """``df`` with ``value`` as a column that is computed once for each row.

    The one-element generator keeps the optimiser from copying the expression into every
    filter and comparison that reads it."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def _template_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _template_bigrams(text: str) -> list[str]:
    w = _template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def window(size: int, threshold: float) -> tuple[float, float]:
    """Least and greatest size of a set that can reach the threshold against one of ``size``."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def anchors(sets: Sequence[list[str]], threshold: float) -> list[str]:
    """Words of which a passage must hold one, as a substring, to reach the threshold against any set.

    A match with n bigrams shares at least n * t / (2 - t) of them.  For every set, words (long ones
    first, then those of many sets) are taken until their bigrams outnumber those that a match may lack."""
    uses = Counter(w for grams in sets for w in {w for g in grams for w in g.split()})
    chosen: set[str] = set()
    for grams in sets:
        lacking = int(len(grams) - window(len(grams), threshold)[0] + 1e-9)
        touched: set[str] = set()
        for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (len(w), uses[w], w), reverse=True):
            if len(touched) > lacking:
                break
            chosen.add(word)
            touched |= {g for g in grams if word in g.split()}
    return sorted(w for w in chosen if not any(o != w and o in w for o in chosen))


def _holds(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def _likely(docs: DataFrame, sets: Sequence[list[str]], threshold: float) -> DataFrame:
    """``docs`` (doc_id, text) whose whole text holds as many bigrams of one template as any match in it must.

    A passage's bigrams are bigrams of its text, line ends being white space, so no match is lost."""
    every = F.array(*[F.lit(g) for g in dict.fromkeys(g for grams in sets for g in grams)])
    forms = F.array(
        *[
            F.struct(F.array(*[F.lit(g) for g in grams]).alias("known"), F.lit(window(len(grams), threshold)[0] - 1e-9).alias("low"))
            for grams in sets
        ]
    )
    split = _once(docs, "w", words(F.col("text")), "doc_id", "text").where(F.size("w") > 1)
    held = _once(split, "held", F.array_intersect(bigrams(F.col("w")), every), "doc_id", "text").where(F.size("held") > 0)
    enough = F.exists(forms, lambda form: F.size(F.array_intersect("held", form["known"])) >= form["low"])
    return held.where(enough).select("doc_id", "text")


def _windows(docs: DataFrame, templates: Sequence[tuple[str, str]], threshold: float) -> DataFrame:
    """(row, doc_id, line, best) of the windows of ``docs`` (row, doc_id, text) that reach the threshold.

    Of the windows that a text starts at successive bigrams of a template only those count whose Dice is
    not below the one before and above the one after, so that a notice is one window."""
    spark = docs.sparkSession
    known, forms = [], []
    for k, (name, text) in enumerate(templates):
        grams, n = _template_bigrams(text), len(_template_words(text))
        if n >= WINDOW_WORDS:
            known += [(k, g) for g in grams]
            forms.append((k, name, grams, n - 1, window(len(grams), threshold)[0] - 1e-9))
    # Both are as large as the templates, whatever the texts.
    known = F.broadcast(spark.createDataFrame(known, "k int, gram string"))
    forms = F.broadcast(spark.createDataFrame(forms, "k int, license string, known array<string>, n int, low double"))
    by_line = F.transform(F.split("text", "\n"), lambda x: F.filter(words(x), lambda w: w != ""))
    held = _once(docs, "by_line", by_line, "row", "doc_id")
    w, lines = F.flatten("by_line"), F.flatten(F.transform("by_line", lambda x, k: F.array_repeat(k + 1, F.size(x))))
    held = _once(held, "w", F.struct(w.alias("w"), lines.alias("lines")), "row", "doc_id").select("row", "doc_id", "w.w", "w.lines")
    held = held.where(F.size("w") >= WINDOW_WORDS)
    grams = F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))
    held = materialise(held.select("row", "doc_id", "lines", grams.alias("grams")), "licence-words")
    hits = held.select("row", F.posexplode("grams").alias("p", "gram")).join(known, "gram")
    hits = hits.groupBy("row", "k").agg(F.sort_array(F.collect_list("p")).alias("starts"), F.size(F.collect_set("gram")).alias("n_found"))
    near = hits.join(forms, "k").where(F.col("n_found") >= F.col("low")).join(held, "row")

    def dice(p: Column) -> Column:
        part = F.slice("grams", p + 1, F.col("n"))
        both = F.size(F.array_distinct(part)) + F.size("known")
        return F.struct((2.0 * F.size(F.array_intersect(part, "known")) / both.cast("double")).alias("dice"), p.alias("p"))

    near = _once(near, "scored", F.transform("starts", dice), "row", "doc_id", "k", "license", "lines")

    def peak(x: Column, i: Column) -> Column:
        before, after = (F.get("scored", i + step).getField("dice") for step in (-1, 1))
        return (x["dice"] >= threshold) & F.coalesce(x["dice"] >= before, F.lit(True)) & F.coalesce(x["dice"] > after, F.lit(True))

    near = near.withColumn("peak", F.explode(F.filter("scored", peak)))
    best = F.struct(F.col("peak.dice").alias("dice"), (-F.col("k")).alias("turn"), F.col("license"))
    return near.select("row", "doc_id", F.get("lines", F.col("peak.p")).alias("line"), best.alias("best"))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, line, license, dice): the best template of every passage that reaches the threshold.

    A passage is a line (numbered from 1), as line 0 the whole text of more than one line, or a window of
    as many words as a template of at least ``WINDOW_WORDS`` has, named by the line in which it starts.
    Ties go to the template named first.  Null and empty texts have no passages; repeated rows
    give repeated matches.  A very long text is one task's work, linear in its length and its matches.
    """
    sets = [(name, grams) for name, text in templates if (grams := _template_bigrams(text))]
    if not sets:
        raise ValueError("templates need at least two words")
    sizes = [window(len(g), threshold) for _, g in sets]
    least, most = min(a for a, _ in sizes), max(b for _, b in sizes)
    # Repeated bigrams make a passage longer than its set, so only the lower bound holds for its words;
    # the upper one is checked on the set.
    # Each expression is computed once; lower() also maps letters beyond A-Z, which adds candidates at most.
    needed = anchors([g for _, g in sets], threshold)
    docs = _once(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), "low", F.lower("text"), "doc_id", "text")
    docs = docs.where(_holds(F.col("low"), needed)).drop("low")
    docs = _likely(docs, [g for _, g in sets], threshold)
    # Row numbers that last: windows are joined back to their texts by them.
    docs = materialise(docs.withColumn("row", F.monotonically_increasing_id()), "licence-texts")
    lines = F.split("text", "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(0).alias("line"), F.col("text").alias("passage"))))
    each = F.transform(lines, lambda x, k: F.struct((k + 1).alias("line"), x.alias("passage")))
    empty = F.array().cast("array<struct<line:int,passage:string>>")
    passages = docs.select("row", "doc_id", F.explode(F.concat(F.coalesce(whole, empty), each)).alias("p"))
    passages = passages.select("row", "doc_id", "p.line", "p.passage").where(_holds(F.lower("passage"), needed))
    split = _once(passages, "w", words(F.col("passage")), "row", "doc_id", "line").where(F.size("w") >= max(2, int(least) + 1))
    grams = _once(split, "g", bigrams(F.col("w")), "row", "doc_id", "line").where(F.size("g").between(least, most))
    found = []
    for k, ((name, known), (low, high)) in enumerate(zip(sets, sizes, strict=True)):
        shared = F.size(F.array_intersect(F.col("g"), F.array(*[F.lit(x) for x in known])))
        dice = F.when(F.size("g").between(low, high), 2.0 * shared / (F.size("g") + len(known)).cast("double")).otherwise(F.lit(0.0))
        found.append(F.struct(dice.alias("dice"), F.lit(-k).alias("turn"), F.lit(name).alias("license")))
    best = _once(grams, "best", F.array_max(F.array(*found)), "row", "doc_id", "line").where(F.col("best.dice") >= threshold)
    every = best.unionByName(_windows(docs, [t for t in templates if _template_bigrams(t[1])], threshold))
    every = every.groupBy("row", "line").agg(F.first("doc_id").alias("doc_id"), F.max("best").alias("best"))
    return every.select("doc_id", "line", "best.license", "best.dice")
