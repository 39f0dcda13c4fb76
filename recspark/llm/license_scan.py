"""License scans by diagonal voting (operator 9), DataFrame functions only.

All rolling word ``K``-gram hashes of the documents are joined with the k-gram
positions of the license templates.  A hit votes for its diagonal (place in the
document minus place in the template); neighbouring diagonals, which differ by
a few words put in or left out, are merged into a candidate span; spans are
verified word by word against the template and scored by the share of the
template that they hold.  Beside this, the base phrases are found where their
words stand consecutively; ``labels`` are those of the base phrases and of the
verified spans together, so that the notice of a lesser licence, which holds the
phrase of the general one, has both.

The templates are a fixed table (``TEMPLATES``), so their k-grams are bounded
and sent to all workers; texts are not shuffled, only hits and candidates are.

Defined cases: null and empty texts have no words, no labels and score 0;
repeated rows get a row each; an empty table gives an empty result; other
columns are ignored.  Rows are numbered in the scan of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, small, table

#: Words end at ASCII characters other than digits and lower-case letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
K = 4
#: Diagonals that are at most this far apart are one candidate.
NEAR = 3
MIN_SCORE = 0.8

#: License notices and key passages, by label (fixed values: public license texts).
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative "
        "Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in "
        "Source or Object form.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
        "allowed.",
    ],
    "lgpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "cc0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software",
    ],
    "busl": [
        "The Licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make "
        "non-production use of the Licensed Work.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ],
}


def _words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, BREAKS), lambda w: w != "")


def _grams(hashes: str) -> Column:
    """Hash of each run of ``K`` words, from a column of word hashes."""
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (K - 1), F.lit(0)))
    return F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(F.col(hashes), i + j) for j in range(1, K)]))


def template_words(spark: SparkSession, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``label, template, words, h`` of the fixed table."""
    rows = [(label, f"{label}/{k}", text) for label, texts in templates.items() for k, text in enumerate(texts)]
    return (spark.createDataFrame(rows, "label string, template string, text string")
            .select("label", "template", _words(F.col("text")).alias("words"))
            .withColumn("h", F.transform("words", lambda w: F.xxhash64(w))))


def candidates(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """``_row, found`` of rows (_row, text): merged diagonals of each template that some k-gram hits."""
    grams = templates.select("template", F.posexplode(_grams("h")).alias("at", "gram"))
    hashed = rows.select("_row", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    # the outer form: for the inner one Spark infers a filter on the array's size and computes it twice
    hits = (hashed.select("_row", F.posexplode_outer(_grams("h")).alias("place", "gram"))
            .where(F.col("gram").isNotNull()))
    votes = (hits.join(F.broadcast(grams), "gram")                    # a fixed table
             .groupBy("_row", "template", (F.col("place") - F.col("at")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes")))
    order = Window.partitionBy("_row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    merged = (votes.withColumn("_new", F.when(gap <= NEAR, 0).otherwise(1))
              .withColumn("g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("_row", "template", "g").agg(F.sort_array(F.collect_list("diagonal")).alias("diagonals")))
    return (merged.join(F.broadcast(templates.select("template", "label")), "template")
            .groupBy("_row").agg(F.collect_list(F.struct("label", "template", "diagonals")).alias("found")))


def _span(c: Column, words_of: Column) -> Column:
    """Words of the candidate's template (looked up in the fixed table) that stand at their place on one of its diagonals."""
    own = F.element_at(words_of, c["template"])
    at = F.filter(F.transform(own, lambda w, j: j + F.get(F.filter(
        c["diagonals"], lambda d: F.get(F.col("words"), (j + d).cast("int")) == w), F.lit(0))), lambda x: x.isNotNull())
    return F.struct(c["label"].alias("label"), F.size(at).alias("matched"),
                    (F.size(at) / F.size(own)).alias("score"),
                    F.array_min(at).alias("first"), F.array_max(at).alias("last"))


def _beats(y: Column, x: Column) -> Column:
    """Another span over the same words explains more of them."""
    overlap = (y["first"] <= x["last"]) & (x["first"] <= y["last"])
    more = (y["matched"] > x["matched"]) | ((y["matched"] == x["matched"]) & (
        (y["score"] > x["score"]) | ((y["score"] == x["score"]) & (y["label"] < x["label"]))))
    return (y["label"] != x["label"]) & overlap & more


def _phrase_starts(phrase: str) -> Column:
    parts = phrase.split(" ")
    return F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: _all(
        [F.get(F.col("words"), i + k) == w for k, w in enumerate(parts)]))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE,
             templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row a document: counts, places and labels of base phrases, verified spans, labels and score."""
    spark = docs.sparkSession
    fixed = template_words(spark, templates)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    found = saved(candidates(rows, fixed), "license-candidates")
    out = (rows.join(small(found), "_row", "left")
           .select("doc_id", _words(F.col("text")).alias("words"), F.coalesce(F.col("text"), F.lit("")).alias("text"), "found"))
    known = fixed.select("template", "words").collect()               # a fixed table
    words_of = F.create_map(*[x for r in known for x in (F.lit(r.template), F.array(*[F.lit(w) for w in r.words]))])
    none = F.array().cast("array<int>")
    maybe = F.col("text").rlike("[Ll][Ii][Cc][Ee][Nn][Ss][Ee]") & (F.size("words") > 0)
    names = {p: f"_p{k}" for k, p in enumerate(PHRASES)}
    out = out.withColumns({names[p]: F.when(maybe, _phrase_starts(p)).otherwise(none) for p in PHRASES})
    starts = F.concat(*[F.col(c) for c in names.values()])
    base = F.array_compact(F.array(*[F.when(F.size(names[p]) > 0, F.lit(label)) for p, label in PHRASES.items()]))
    out = out.select("doc_id", F.size("words").cast("long").alias("n_words"), starts.alias("_starts"), base.alias("_base"),
                     F.when(F.col("found").isNotNull(), F.transform("found", lambda c: _span(c, words_of))).alias("_spans"))
    out = out.withColumn("_ok", F.filter("_spans", lambda x: x["score"] >= min_score))
    out = out.withColumn("spans", F.filter("_ok", lambda x: ~F.exists("_ok", lambda y: _beats(y, x))))
    no_text = F.array().cast("array<string>")
    labels = F.array_sort(F.array_distinct(F.concat(
        "_base", F.coalesce(F.transform("spans", lambda x: x["label"]), no_text))))
    return out.select(
        "doc_id", "n_words", F.size("_starts").cast("long").alias("n_base"),
        F.array_min("_starts").cast("long").alias("first_word"), F.array_max("_starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("_spans", lambda x: x["score"])), F.lit(0.0)).alias("score"), "spans")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and verified notices of every document."""
    return licenses(table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {"op9_license_scan": op9_license_scan}
SQL: dict = {}
