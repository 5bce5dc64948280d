"""Licence scan: text against licence templates by the Dice coefficient over word bigrams.

Text is normalised to its ASCII words in lower case and cut into pieces: at line feeds, and
behind sentence ends that blanks follow; pieces without words do not count. A unit is any
run of consecutive pieces, so a notice is found inside a line, over wrapped lines and over
several paragraphs, whatever stands around it.

The coefficient of two bigram multisets is 2 * shared / (size + size), so a unit can only
reach the threshold t with a template of n bigrams if it has from n*t/(2-t) to n*(2-t)/t
itself. These size bounds are applied twice: a piece above all of them is dropped before
any bigram is made, and a run is only formed within those of its template. Besides, a run
starts and ends with pieces that have t/2 bigrams of the template per word or more, the
one that leads into the piece included: with an end below that, it scores less than without.

The templates are a parameter, and their bigrams the only side that is broadcast: at
most MAX_BIGRAMS rows.
"""

from __future__ import annotations

import json
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed

THRESHOLD = 0.8
MAX_BIGRAMS = 100_000
ASCII_WORD = "[0-9A-Za-z]+"
SENTENCE_END = "([.!?])[ \t\r]+"

# Public licence notices and texts.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the GNU Affero General Public License, version 3.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "Released under the GNU Lesser General Public License, version 3.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the GNU Lesser General Public License, version 2.1.",
    ],
    "MPL-2.0": [
        "This work is licensed under the Mozilla Public License, version 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be "
        "plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may "
        "not be removed or altered from any source distribution.",
    ],
}


def _words(text: str) -> list[str]:
    return [w.lower() for w in re.findall(ASCII_WORD, text)]


def template_rows(templates: dict[str, list[str]]) -> list[tuple[str, int, int, str, int]]:
    """(license_id, template, bigrams of it, bigram, times) of every template that has one."""
    rows = []
    for license_id, texts in templates.items():
        for number, text in enumerate(texts):
            words = _words(text)
            counts = Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))
            size = counts.total()
            rows += [(license_id, number, size, gram, n) for gram, n in sorted(counts.items())]
    if len(rows) > MAX_BIGRAMS:
        raise ValueError(f"the templates have {len(rows)} bigrams, more than {MAX_BIGRAMS}")
    return rows


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The fewest and the most bigrams that reach the threshold with a template of `size`; `dice` tells at the ends."""

    def reaches(n: int) -> bool:
        return 2.0 * min(n, size) / (n + size) >= threshold

    low = next(n for n in range(1, size + 1) if reaches(n))
    high = size
    while reaches(high + 1):
        high += 1
    return low, high


def scan_licenses(
    docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per run of pieces of a document that is the best of one of its pieces.

    Columns: doc_id, first_piece, last_piece (from 0), first_word, n_words, license_id,
    template, dice. Of the runs that reach the threshold and hold a piece, its best is that
    of the greatest dice; ties go to the earlier first word, then last word, license_id and
    number of the template. Null and empty texts have no pieces; texts without two ASCII
    words match nothing. Rows of `docs` that repeat give repeated rows. Other columns are
    not read. `threshold` is above 0 and at most 1.
    """
    rows = template_rows(TEMPLATES if templates is None else templates)
    spark = docs.sparkSession
    bounds = {size: size_bounds(size, threshold) for size in {r[2] for r in rows}}
    most = max((high for _, high in bounds.values()), default=0)
    grams = spark.createDataFrame(
        [(*r, *bounds[r[2]]) for r in rows],
        "license_id string, template int, size int, gram string, times int, low int, high int",
    )
    known = grams.select("gram").distinct()
    text = F.regexp_replace("text", SENTENCE_END, "$1\n")
    matched = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_extract_all(x, F.lit(ASCII_WORD), F.lit(0)))
    listed = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").filter(F.length("text") > 0)

    # Rows are made of a list of one, as later on every use of a column would match the text again.
    def once(column: Column, name: str) -> Column:
        return F.explode(F.array(column)).alias(name)

    pieces = listed.select("doc_id", "row", once(F.filter(matched, lambda w: F.size(w) > 0), "pieces"))
    flat = F.flatten(
        F.transform(
            "pieces",
            lambda words, i: F.transform(
                words, lambda w, k: F.struct(i.alias("piece"), k.alias("k"), F.size(words).alias("len"), w.alias("w"))
            ),
        )
    )
    worded = pieces.select("doc_id", "row", once(flat, "words"))

    def pair(i: Column, of: Column, first: Column) -> Column:
        here, after = F.get("words", i - 1), F.get("words", i)
        gram = F.lower(F.concat_ws(" ", here["w"], after["w"])).alias("gram")
        return F.struct((i - 1).alias("at"), of["piece"].alias("piece"), first.alias("first"), of["len"].alias("len"), gram)

    places = F.sequence(F.lit(1), F.size("words") - 1)
    own = F.transform(places, lambda i: pair(i, F.get("words", i - 1), i - 1 - F.get("words", i - 1)["k"]))
    # The bigram that leads into a piece tells of that piece, too.
    leads = F.transform(F.filter(places, lambda i: F.get("words", i)["k"] == 0), lambda i: pair(i, F.get("words", i), i))
    each = worded.filter(F.size("words") > 1).select("doc_id", "row", F.inline(F.concat(own, leads)))
    hits = each.filter(F.col("len") - 1 <= most).join(F.broadcast(known), "gram")
    # A piece has `most` + 1 words at most, so its list is bounded by the templates.
    width = most + 1
    found = hits.groupBy("doc_id", "row", "piece", "first", "len").agg(F.collect_list(F.struct("at", "gram")).alias("hits"))
    found = checkpointed(found.withColumn("last", F.col("first") + F.col("len") - 1))

    least = F.col("len") * (threshold / 2)
    dense = found.filter(F.size("hits") >= least).select("row", "piece", "first", "last", "len", F.inline("hits"))
    whose = ["row", "license_id", "template", "size", "low", "high"]
    edges = (
        dense.join(F.broadcast(grams), "gram")
        .groupBy(*whose, "piece", "first", "last", "len")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least)
    )
    edges = checkpointed(edges.drop("n", "len"))

    # A run is no longer than a cell, so it lies in the cell of its first word and the next one.
    def cell(column: str) -> Column:
        return F.floor(F.col(column) / width)

    opens = edges.select(*whose, "first", F.col("piece").alias("first_piece"), cell("first").alias("c"))
    opens = opens.withColumn("cell", F.explode(F.array(F.col("c"), F.col("c") + 1))).drop("c")
    closes = edges.select(
        "row", "license_id", "template", "last", F.col("piece").alias("last_piece"), cell("last").alias("cell")
    )
    runs = (
        opens.join(closes, ["row", "license_id", "template", "cell"])
        .withColumn("n", F.col("last") - F.col("first"))
        .filter(F.col("n").between(F.col("low"), F.col("high")))
        .drop("cell", "low", "high")
    )
    at = F.explode(F.sequence(cell("first"), cell("last"))).alias("cell")
    inside = found.select(
        "doc_id", F.col("row").alias("of_row"), F.col("first").alias("of_first"), cell("first").alias("of_cell"), "hits"
    )
    met = runs.select("*", at).join(
        inside,
        (F.col("row") == F.col("of_row")) & (F.col("cell") == F.col("of_cell")) & F.col("of_first").between(F.col("first"), F.col("last")),
    )
    run = ["doc_id", "row", "license_id", "template", "size", "first", "last", "first_piece", "last_piece", "n"]
    counted = met.select(*run, "of_first", F.inline("hits")).filter(F.col("at").between(F.col("of_first"), F.col("last") - 1))
    asked = grams.select("license_id", "template", "gram", "times")
    dice = (
        counted.join(F.broadcast(asked), ["license_id", "template", "gram"])
        .groupBy(*run, "gram", "times")
        .agg(F.count(F.lit(1)).alias("here"))
        .groupBy(*run)
        .agg(F.sum(F.least("here", "times")).alias("shared"))
        .withColumn("dice", 2.0 * F.col("shared") / (F.col("n") + F.col("size")))
        .filter(F.col("dice") >= threshold)
    )
    order = F.struct((-F.col("dice")).alias("d"), "first", "last", "license_id", "template", "first_piece", "last_piece")
    best = (
        dice.select("doc_id", "row", order.alias("run"), F.explode(F.sequence("first_piece", "last_piece")).alias("piece"))
        .groupBy("doc_id", "row", "piece")
        .agg(F.min("run").alias("run"))
        .select("doc_id", "row", "run")
        .distinct()
    )
    return best.select(
        "doc_id",
        "run.first_piece",
        "run.last_piece",
        F.col("run.first").alias("first_word"),
        (F.col("run.last") - F.col("run.first") + 1).alias("n_words"),
        "run.license_id",
        "run.template",
        (-F.col("run.d")).alias("dice"),
    )


def template_values(templates: dict[str, list[str]] | None = None) -> str:
    """The templates' bigrams as rows of an SQL VALUES list."""
    rows = template_rows(TEMPLATES if templates is None else templates)
    return ", ".join(f"('{a}', {b}, {c}, {json.dumps(d)[1:-1]!r}, {e})" for a, b, c, d, e in rows)
