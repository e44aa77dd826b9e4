"""License scans by diagonal voting.

Every rolling 3-gram of a document's words is joined, by its hash, to the places where it stands in the
templates (a fixed table that the caller gives; it is broadcast). A match votes for the diagonal "place in the
document minus place in the template". A phrase stands wherever all its 3-grams vote for one diagonal. For
the longer templates, neighbouring diagonals (a few words added or left out) are merged, and a merged span
is verified: its votes must cover ``coverage`` of the template's words within little more than its length.

Defined results: a null text has no words; fewer than three words match nothing; repeated rows each give
their row; rows without id too; an empty table gives no rows; texts of any length are scanned whole. The
score is the largest part of any template that a verified span covers (1 for a phrase, 0 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import Words, finish, utf8_column

GRAM = 3

# The phrases of the contract with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices as the licenses' stewards word them.
TEMPLATES: dict[str, list[str]] = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"],
    "apache-2": ["you may not use this file except in compliance with the License. You may obtain a copy of the "
                 "License at"],
    "gpl-3": ["GNU General Public License, version 3",
              "under the terms of the GNU General Public License as published by the Free Software Foundation, "
              "either version 3 of the License"],
    "lgpl-3": ["GNU Lesser General Public License, version 3"],
    "agpl-3": ["GNU Affero General Public License, version 3"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"],
    "mpl-2": ["subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by": ["licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["CC0 1.0 Universal"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

# Whole texts, as published; where two licenses share sentences, each has its own text with its own label.
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
FULL_TEXTS: dict[str, list[str]] = {
    "mit-text": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "isc-text": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."],
    "bsd-2-text": [f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"],
    "bsd-3-text": [f"{_BSD_CONDITIONS} {_BSD_THIRD} {_BSD_DISCLAIMER}"],
    "zlib-text": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."],
    "apache-2-notice": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."],
    "gpl-2-notice": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."],
}
BROADCAST_PLACES = 200_000


def gram_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rolling word 3-grams within each text, and len + 1 offsets."""
    h = words.hash.view(np.uint64)
    n = np.maximum(np.diff(words.first) - GRAM + 1, 0)
    ends = np.cumsum(n)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.first[:-1] - (ends - n), n)
    value = h[at] * np.uint64(0x9E3779B97F4A7C15)
    for i in range(1, GRAM):
        value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + h[at + i]
    return finish(value), np.concatenate([[0], ends])


def _template_rows(phrases: Mapping[str, str], templates: Mapping[str, Sequence[str]]) -> list[tuple]:
    texts = [(label, text, True) for text, label in phrases.items()]
    texts += [(label, text, False) for label, own in templates.items() for text in own]
    words = Words(*utf8_column(pa.array([t[1] for t in texts], pa.string())))
    hashes, offsets = gram_hashes(words)
    size = np.diff(words.first)
    if len(texts) and size.min() < GRAM:
        raise ValueError(f"a template needs at least {GRAM} words")
    return [(int(hashes[p]), i, label, phrase, int(size[i]), int(p - offsets[i]))
            for i, (label, _, phrase) in enumerate(texts) for p in range(offsets[i], offsets[i + 1])]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] = PHRASES,
         templates: Mapping[str, Sequence[str]] = {**TEMPLATES, **FULL_TEXTS}, slack: int = 3, coverage: float = 0.8) -> DataFrame:
    """Per row of ``docs``: the id column, n_words, spans (array of label, phrase, first, end, coverage), score."""
    spark = docs.sparkSession
    places = _template_rows(phrases, templates)
    table = spark.createDataFrame(
        places, "gram long, template int, label string, phrase boolean, size int, place int")
    if len(places) <= BROADCAST_PLACES:  # a larger set of templates is joined by a shuffle of both sides
        table = F.broadcast(table)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_column(batch.column("text"))
            a = 0
            while a < batch.num_rows:  # about 1 MB of text at a time
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + (1 << 20), "right")) - 1)
                words = Words(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                hashes, bounds = gram_hashes(words)
                part = batch.slice(a, b - a)
                # -1 is no hash: it stands for the document itself, at place -1
                marked = np.insert(hashes, bounds[:-1], -1)
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds + np.arange(b - a + 1), pa.int32()), pa.array(marked))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("mark"), pa.array(np.diff(words.first)), lists],
                    ["id", "mark", "n_words", "grams"])
                a = b

    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    listed = own.mapInArrow(grams, T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("mark", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))]))
    every = listed.select("id", "mark", "n_words", F.posexplode("grams").alias("at", "gram"))
    voted = every.join(table, "gram", "left").where("template is not null or gram = -1")
    voted = voted.withColumn("at", F.col("at") - 1).withColumn("diagonal", F.col("at") - F.col("place"))
    # all that follows happens within a document; rows of one id and text are counted, not mixed
    voted = voted.repartition("id", "mark")
    doc = ["id", "mark"]
    by_diagonal = voted.groupBy(*doc, "template", "label", "phrase", "size", "diagonal").agg(
        F.max("n_words").alias("n_words"), F.count("*").alias("votes"),
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last"))
    near = W.partitionBy(*doc, "template").orderBy("diagonal")
    apart = F.col("phrase") | F.col("template").isNull() | (
        F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near), F.lit(slack + 1)) > slack)
    merged = by_diagonal.withColumn("apart", apart.cast("int")) \
        .withColumn("span", F.sum("apart").over(near)) \
        .groupBy(*doc, "template", "label", "phrase", "size", "span").agg(
            F.max("n_words").alias("n_words"), F.max("votes").alias("votes"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.min("first").alias("first"), (F.max("last") + GRAM).alias("end"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p, p + (GRAM - 1))))))
    part = covered / F.col("size")
    whole = F.col("phrase") & (F.size("places") == F.col("size") - (GRAM - 1))
    alike = ~F.col("phrase") & (part >= coverage) & (F.col("end") - F.col("first") <= 1.25 * F.col("size") + slack)
    span = F.when(whole | alike, F.struct(
        "label", "phrase", F.col("first").cast("long").alias("first"), F.col("end").cast("long").alias("end"),
        part.alias("coverage")))
    found = merged.groupBy(*doc).agg(
        F.max("n_words").alias("n_words"), F.max(F.when(F.col("template").isNull(), F.col("votes"))).alias("copies"),
        F.sort_array(F.collect_list(span)).alias("spans"))
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return found.select(
        F.col("id").alias(id_col), "n_words", "spans",
        F.coalesce(F.array_max(F.transform("spans", lambda s: s.coverage)), F.lit(0.0)).alias("score"))
