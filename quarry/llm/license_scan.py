"""Licence scan: TF-IDF cosine of header lines to templates, then directory inheritance (native).

1. Every line of every text that holds a licence marker is a header line. It is
   scored alone, joined with the line before, the line after and both, and, if
   it is longer than every template, in windows of the templates' lengths. A
   licence file's whole text is one more header. Equal headers are one row, so
   a notice in a third of all files is scored once.
2. Words are weighted by term count times inverse document frequency, counted
   over the header lines of all files. The cosine to each template is a sparse
   product: a join on words with the template vectors (a fixed table), summed
   per header and template. Templates are one-line notices, licence tags and
   whole licence texts, each kind with its own threshold; texts are compared
   with whole licence files, so a file is known by all of its clauses.
   A header takes its best template, unless another licence's template of the
   same kind comes within ``margin``: then it says nothing ("GNU General Public
   License" without a version). A file takes its best header's licence: a whole
   text before a notice or tag, those before a reservation of rights alone.
3. Directories get the licence of the licence files directly in them (the most
   frequent, ties by name). A file without its own licence takes that of the
   nearest directory above it that has one. Ancestors are joined per distinct
   directory, not per file.

Defined results: null or empty text has no licence of its own; a null path is
in no directory and inherits nothing; ties between a file's headers go to the
smaller licence name; a header between two licences has none;
repeated rows each get a result; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, col, let, write_scratch

# Marker words, one-line notices, licence tags and whole licence texts.
MARKERS = r"(?i)licen[cs]|copyright|spdx|warrant|rights reserved|creative commons|public domain|redistribut|permission is hereby"
SPLIT_MARKERS = MARKERS.replace(" ", r"\s+")  # also across a line end
TEMPLATES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Released into the public domain under the Creative Commons CC0 1.0 Universal dedication"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "All rights reserved"),
)
TAGGED = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC",
          "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
TAGS = tuple((name, f"SPDX-License-Identifier: {name}{end}") for name in TAGGED for end in (("", "-only", "-or-later") if "GPL" in name else ("",)))
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. ")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEXTS = (
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER),
    ("ISC",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR "
     "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
     "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
     "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
     "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
     "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
     "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
     "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Unlicense",
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
     "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate "
     "any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
     "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
     "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY "
     "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
     "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
     "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)
#: Kinds of template: (rank, least cosine). A lower rank goes before a better score.
TEXT, NOTICE, TAG, RESERVED = (0, 0.8), (1, 0.6), (1, 0.9), (2, 0.6)
MARGIN = 0.02


def _terms(line: Column) -> Column:
    return F.filter(F.split(ascii_lower(line), "[^a-z0-9]+", -1), lambda w: w != "")


def _vectors(lines: DataFrame, idf: DataFrame, n: Column) -> DataFrame:
    """(key, term, weight / norm) of (key, terms); ``idf`` has (term, df), a term that it lacks has df 0."""
    tf = lines.select("key", F.explode("terms").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    weighted = tf.join(idf, "term", "left").select(
        "key", "term", (F.col("tf") * (F.log((1 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1)).alias("w"))
    norms = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "key").select("key", "term", (F.col("w") / F.col("norm")).alias("w"))


def _flat(text: Column) -> Column:
    return F.array_join(_terms(text), " ")


def _headers(text: Column, whole: Column, templates) -> Column:
    """The distinct headers of a text as strings of terms; no header if it holds no marker, but for a ``whole`` text itself."""
    none = F.array().cast("array<string>")
    sizes = sorted({len(re.findall("[a-z0-9]+", line.lower())) for _, line in templates})

    def windows(line: Column) -> Column:
        # Runs of a template's length in a line longer than any template.
        terms = F.split(_flat(line), " ")

        def cut(t: Column, k: int) -> Column:
            return F.transform(F.sequence(F.lit(1), F.size(t) - k + 1), lambda i: F.array_join(F.slice(t, i, k), " "))

        runs = let(terms, lambda t: F.when(F.size(t) > max(sizes, default=0), F.flatten(F.array(*[cut(t, k) for k in sizes]))))
        return F.coalesce(F.filter(runs, lambda r: r.rlike(MARKERS)), none)

    def of(lines: Column) -> Column:
        def near(line: Column, i: Column) -> Column:
            before, after = F.get(lines, i - 1), F.get(lines, i + 1)
            pair, three = F.concat_ws(" ", line, after), F.concat_ws(" ", before, line, after)
            return F.when(line.rlike(MARKERS), F.concat(F.transform(F.array(line, F.concat_ws(" ", before, line), pair, three), _flat), windows(line))) \
                .when(pair.rlike(SPLIT_MARKERS), F.array(_flat(pair))).otherwise(none)
        return F.flatten(F.transform(lines, near))

    found = F.when(text.rlike(SPLIT_MARKERS), let(F.split(text, "\n", -1), of)).otherwise(none)
    return F.array_distinct(F.concat(found, F.when(whole, F.array(_flat(text))).otherwise(none)))


def _table(templates, tags, texts) -> list[tuple[str, str, str, int, float]]:
    """(key, licence, line, rank, least cosine) of every template."""
    kinds = [(x, RESERVED if x[0] == "Proprietary" else NOTICE) for x in templates] + [(x, TAG) for x in tags] + [(x, TEXT) for x in texts]
    return [(str(k), licence, line, *kind) for k, ((licence, line), kind) in enumerate(kinds)]


def header_licences(files: DataFrame, text_col: str = "text", templates=TEMPLATES, whole: Column | None = None, tags=TAGS, texts=TEXTS,
                    margin: float = MARGIN) -> tuple[DataFrame, Column]:
    """((header, rank, licence, score) of every distinct header with a licence, the expression of a text's headers).

    Headers go by the md5 of their terms. ``whole``: texts whose whole term vector is scored too.
    """
    spark = files.sparkSession
    text = col(text_col)
    lines = files.select(F.explode(F.split(text, "\n", -1)).alias("line")).filter(F.col("line").rlike(MARKERS))
    weighed = write_scratch(lines.select(_flat(F.col("line")).alias("header")).groupBy("header").agg(F.count("*").alias("n")), "headers")
    n = weighed.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    idf = weighed.select(F.explode(F.array_distinct(F.split("header", " "))).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("df"))
    idf = write_scratch(idf, "header-df")
    table = spark.createDataFrame(_table(templates, tags, texts), "template string, licence string, line string, rank int, least double")
    model = _vectors(table.select(F.col("template").alias("key"), _terms(F.col("line")).alias("terms")), idf, F.lit(n))
    model = model.select(F.col("key").alias("template"), "term", F.col("w").alias("v")).join(table.drop("line"), "template")
    headers = _headers(text, F.lit(False) if whole is None else whole, templates)
    own = files.select(F.explode(headers).alias("header")).groupBy(F.md5("header").alias("key")).agg(F.first("header").alias("header"))
    own = own.select("key", F.split("header", " ").alias("terms"))
    cosine = _vectors(own, idf, F.lit(n)).join(F.broadcast(model), "term") \
        .groupBy("key", "template", "licence", "rank", "least").agg(F.round(F.sum(F.col("w") * F.col("v")), 6).alias("score")) \
        .filter("score >= least")
    hits = cosine.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", (-F.col("score")).alias("neg"), "licence"))).alias("hits"))  # at most one a template
    best = F.col("hits")[0]
    rivals = F.exists("hits", lambda x: (x["rank"] == best["rank"]) & (x["licence"] != best["licence"]) & (x["neg"] - best["neg"] < margin))
    judged = hits.filter(~rivals).select(F.col("key").alias("header"), best["rank"].alias("rank"), best["licence"].alias("licence"), (-best["neg"]).alias("score"))
    return judged, F.transform(headers, F.md5)


def scan_licences(files: DataFrame, id_col: str, path: Column, text_col: str = "text", is_licence_file: Column | None = None,
                  templates=TEMPLATES, tags=TAGS, texts=TEXTS, margin: float = MARGIN) -> DataFrame:
    """(id, path, own_licence, score, licence, from_dir) per row of ``files``.

    ``path``: slash-separated path of a file. ``is_licence_file``: which files
    speak for their directory (default: by name, LICENSE, COPYING or NOTICE).
    ``licence`` is the file's own or, failing that, that of ``from_dir``.
    """
    name = F.element_at(F.split(path, "/"), -1)
    flag = is_licence_file if is_licence_file is not None else name.rlike(r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$")
    rows = files.select(col(id_col).alias("id"), path.alias("path"), col(text_col).alias("text"), F.coalesce(flag, F.lit(False)).alias("flag"))
    rows = rows.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(
        F.when(F.col("path").isNotNull(), F.lit(""))))
    # Texts that can have a header, found by one scan.
    marked = write_scratch(rows.filter(F.col("flag") | F.col("text").rlike(SPLIT_MARKERS)).select("id", "path", "text", "flag"), "marked")
    scored, headers = header_licences(marked, "text", templates, F.col("flag"), tags, texts, margin)
    scored = write_scratch(scored, "scored-headers")
    # A file's distinct headers; a repeated id with another path is another file.
    held = marked.select("id", "path", F.explode(headers).alias("header"))
    own = held.join(scored, "header").groupBy("id", "path").agg(F.min(F.struct("rank", (-F.col("score")).alias("neg"), "licence")).alias("b"))
    own = own.select(F.col("id").alias("o_id"), F.col("path").alias("o_path"), F.col("b.licence").alias("own_licence"), (-F.col("b.neg")).alias("score"))
    slim = rows.select("id", "path", "dir", "flag")
    judged = write_scratch(slim.join(own, slim.id.eqNullSafe(own.o_id) & slim.path.eqNullSafe(own.o_path), "left").drop("o_id", "o_path"), "judged")

    votes = judged.filter("flag AND own_licence IS NOT NULL AND dir IS NOT NULL").groupBy("dir", "own_licence").agg(F.count("*").alias("c"))
    says = votes.groupBy("dir").agg(F.min(F.struct((-F.col("c")).alias("neg"), F.col("own_licence").alias("l"))).alias("b")) \
        .select(F.col("dir").alias("above"), F.col("b.l").alias("licence"))
    dirs = judged.filter("dir IS NOT NULL").groupBy("dir").agg(F.lit(1).alias("one")).select("dir")
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    nearest = dirs.select("dir", F.explode(F.array_distinct(ancestors)).alias("above")).join(says, "above") \
        .groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "licence")).alias("b")) \
        .select("dir", F.col("b.licence").alias("dir_licence"), F.col("b.above").alias("above"))
    out = judged.join(write_scratch(nearest, "nearest"), "dir", "left")
    inherits = F.col("own_licence").isNull()
    return out.select(F.col("id").alias(id_col), "path", "own_licence", "score", F.coalesce("own_licence", "dir_licence").alias("licence"),
                      F.when(inherits, F.col("above")).alias("from_dir"))
