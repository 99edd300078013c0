"""License scan: TF-IDF cosine to license templates, then inheritance along directories.

A file's license is that of its best window: a run of lines, a sentence, a paragraph or the whole
text around a line that speaks of licenses.  Terms are weighed by how rare they are among all
notices and templates; the cosine to every template sums the products of equal terms only, so
windows and templates meet in a sparse join.  A file without a license of its own takes that of
the license file in its nearest ancestor directory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inboxlens.llm.common import fresh, settle

#: Notices as they stand in file headers and license files, by SPDX identifier.  Fixed values.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License, either version 3 of the License"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("Proprietary", "Copyright. All rights reserved."),
)
#: Full texts, or the titles and operative paragraphs of long ones, and headers as their licenses
#: advise them.  They are matched like ``TEMPLATES`` and take no part in the document frequencies.
TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person "
            "obtaining a copy of this software and associated documentation files (the Software), "
            "to deal in the Software without restriction, including without limitation the rights "
            "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions: The above copyright notice and this permission notice shall "
            "be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
            "PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
            "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
            "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
            "THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met: "
                     "Redistributions of source code must retain the above copyright notice, this "
                     "list of conditions and the following disclaimer. Redistributions in binary "
                     "form must reproduce the above copyright notice, this list of conditions and "
                     "the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution. Neither the name of the copyright holder nor the names "
                     "of its contributors may be used to endorse or promote products derived from "
                     "this software without specific prior written permission."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *(
        (name, f"This program is free software: you can redistribute it and/or modify it under the "
               f"terms of the GNU {kind} as published by the Free Software Foundation, either "
               f"version {version} of the License, or (at your option) any later version.")
        for name, kind, version in (
            ("GPL-2.0", "General Public License", 2),
            ("GPL-3.0", "General Public License", 3),
            ("LGPL-3.0", "Lesser General Public License", 3),
            ("AGPL-3.0", "Affero General Public License", 3),
        )
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
)
#: A line with one of these words is a notice line; document frequencies are counted over them.
NOTICE = r"licen[sc]e|copyright|all rights reserved|public domain|spdx-license-identifier"
#: Every window holds a line with one of these: the notice words and those of templates without any.
ANCHOR = (
    NOTICE + r"|hereby|redistribut|creative commons|\bcc0\b|\bcc[ -]by\b|free software|source code form"
)
#: Lines that a window of lines has at most; longer passages are paragraphs, or the whole text.
SPAN = 4
#: Cosine from which a window counts as the template's.
THRESHOLD = 0.6
#: Share of a file's words in notice lines from which it is a license file.
WHOLE_FILE = 0.5
#: Cosine from which a window with that share of the words makes a license file too.
WHOLE_COSINE = 0.8
#: What reserves all rights yields to any license granted in the same file.
RESERVED = "Proprietary"
_TERM = r"[^\p{L}\p{N}.\-]+"


def _terms(text: Column) -> Column:
    """Lower-cased words and numbers; dots and hyphens stay inside only."""
    words = F.transform(F.split(F.lower(text), _TERM), lambda w: F.regexp_replace(w, r"^[.\-]+|[.\-]+$", ""))
    return F.filter(words, lambda w: w != "")


def _templates(spark: SparkSession, templates) -> DataFrame:
    """``(template, term, tf)``; a template's key is its license, a blank and its number."""
    rows = [
        F.struct(F.lit(f"{name} {k}").alias("template"), F.lit(text).alias("text"))
        for k, (name, text) in enumerate(templates)
    ]
    words = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select(
        "t.template", F.explode(_terms(F.col("t.text"))).alias("term")
    )
    return words.groupBy("template", "term").agg(F.count(F.lit(1)).alias("tf"))


def _count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def notices(files: DataFrame, *, path_col: str, text_col: str) -> DataFrame:
    """``(path, notice, whole)`` of files with notice lines; ``whole`` marks license files."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda line: F.lower(line).rlike(NOTICE))
    return (
        files.select(F.col(path_col).alias("path"), text.alias("text"))
        .filter(F.lower("text").rlike(NOTICE))
        .withColumn("notice", F.array_join(lines, "\n"))
        .select(
            "path", "notice",
            F.coalesce(
                (_count(F.col("notice")) >= WHOLE_FILE * _count(F.col("text"))) | _named("path"), F.lit(False)
            ).alias("whole"),
        )
    )


def _runs(words: str) -> Column:
    """``(term, tf)`` of a sorted array of words, from the places where a new word begins."""
    at = F.filter(
        F.sequence(F.lit(1), F.size(words) + 1),
        lambda i: (i == 1) | (i > F.size(words)) | (F.get(words, i - 1) != F.get(words, i - 2)),
    )
    return F.zip_with(
        F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1),
        lambda i, j: F.struct(F.get(words, i - 1).alias("term"), (j - i).alias("tf")),
    )


def _named(path: str) -> Column:
    """Whether a file's name is that of a license file."""
    return F.lower(F.element_at(F.split(path, "/"), -1)).rlike(r"^(licen[sc]e|copying|notice)(\.|$)")


def windows(files: DataFrame, *, path_col: str, text_col: str) -> DataFrame:
    """``(path, window, half, named)``: passages of the files around lines with an anchor word.

    Runs of up to ``SPAN`` lines, sentences and paragraphs (a line without letters and digits ends
    one), and the whole text.  ``half`` marks windows with half of the file's words, ``named`` files
    with a license file's name.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    speaks = lambda t: F.lower(t).rlike(ANCHOR)

    def runs(n: int) -> Column:
        def of(i: Column) -> Column:
            begins = F.sequence(F.greatest(i - n + 1, F.lit(1)), i)
            return F.transform(begins, lambda k: F.array_join(F.slice("lines", k, n), " "))

        return F.flatten(F.transform("at", of))

    sentences = F.flatten(
        F.transform("paragraphs", lambda p: F.split(p, r"(?<=[.;:!?])[^\p{L}\p{N}]+(?=\p{Lu})"))
    )
    return (
        files.select(F.col(path_col).alias("path"), text.alias("text"))
        .filter(speaks("text"))
        .withColumn("lines", F.split("text", "\n"))
        .withColumn("paragraphs", F.filter(F.split("text", r"\n(?:[^\p{L}\p{N}\n]*\n)+"), speaks))
        .withColumn("at", F.filter(
            F.sequence(F.lit(1), F.size("lines")), lambda i: speaks(F.element_at("lines", i))
        ))
        .select(
            "path", _named("path").alias("named"), _count(F.col("text")).alias("size"),
            F.explode(F.array_distinct(F.concat(
                *(runs(n) for n in range(1, SPAN + 1)),
                F.filter(sentences, speaks), F.col("paragraphs"), F.array("text"),
            ))).alias("window"),
        )
        .select(
            "path", "window", "named",
            (_count(F.col("window")) >= WHOLE_FILE * F.col("size")).alias("half"),
        )
    )


def detect(files: DataFrame, *, path_col: str, text_col: str, templates=TEMPLATES,
           threshold: float = THRESHOLD, texts=TEXTS) -> DataFrame:
    """``(path, whole, license, similarity)`` of the files with a window that reaches the threshold.

    Document frequencies are counted over the notices of all files and all templates; a term in
    none of them has a frequency of 0.  Windows of equal words are weighed once: a notice that a
    third of all files carries is one row in the join.  Ties between templates go to the first by
    name, and ``RESERVED`` comes after any license.
    """
    spark = files.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spoken = settle(
        files.select(F.col(path_col).alias("path"), text.alias("text")).filter(F.lower("text").rlike(ANCHOR))
    )

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        return rows.withColumn("words", F.array_sort(_terms(F.col(name)))).withColumn(
            "key", F.sha2(F.array_join("words", " "), 256)
        ).drop(name)

    def kinds_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("files"))

    found = settle(keyed(notices(spoken, path_col="path", text_col="text"), "notice"))
    kinds = settle(kinds_of(found))
    wanted = _templates(spark, templates)
    frequency = (
        kinds.select("files", F.explode(F.array_distinct("words")).alias("term"))
        .unionByName(wanted.select(F.lit(1).cast("bigint").alias("files"), "term"))
        .groupBy("term")
        .agg(F.sum("files").alias("df"))
    )
    total = (kinds.agg(F.sum("files")).first()[0] or 0) + len(templates)
    idf = settle(frequency.select("term", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf")))

    passages = settle(keyed(windows(spoken, path_col="path", text_col="text"), "window"))
    # narrow numbers stand for the different windows; once written they stay
    numbered = settle(kinds_of(passages).select("key", "words", F.monotonically_increasing_id().alias("n")))

    def weighed(rows: DataFrame, key: str) -> DataFrame:
        return rows.join(idf, "term", "left").select(
            key, "term",
            ((1 + F.log("tf")) * F.coalesce("idf", F.lit(math.log(total + 1) + 1))).alias("weight"),
        )

    def norms(rows: DataFrame, key: str, name: str) -> DataFrame:
        return rows.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias(name))

    # the terms of a window leave its row side by side, so sums by window shrink before they travel
    left = weighed(numbered.select("n", F.inline(_runs("words"))), "n")
    right = weighed(_templates(spark, (*templates, *texts)), "template").withColumnRenamed("weight", "other")
    sizes = norms(right.withColumnRenamed("other", "weight"), "template", "other_norm")
    scored = (
        left.join(right, "term")
        .groupBy("n", "template")
        .agg(F.sum(F.col("weight") * F.col("other")).alias("product"))
        .join(norms(left, "n", "norm"), "n")
        .join(sizes, "template")
        .withColumn("similarity", F.round(F.col("product") / F.col("norm") / F.col("other_norm"), 6))
        .filter(F.col("similarity") >= threshold)
        .join(numbered.select("n", "key"), "n")
        .select("key", "template", "similarity")
    )
    # a license's best window in every file, then the file's best license
    told = (
        passages.drop("words").join(scored, "key")
        .withColumn("license", F.substring_index("template", " ", 1))
        .groupBy("path", "license")
        .agg(
            F.min(F.struct((-F.col("similarity")).alias("far"), "template")).alias("top"),
            F.bool_or(F.col("named") | F.col("half") & (F.col("similarity") >= WHOLE_COSINE)).alias("whole"),
        )
        .groupBy("path")
        .agg(F.min(F.struct(
            (F.col("license") == RESERVED).alias("reserved"), "top.far", "top.template", "license", "whole"
        )).alias("best"))
    )
    marked = found.groupBy("path").agg(F.bool_or("whole").alias("marked"))
    return told.join(marked, "path", "left").select(
        "path",
        F.coalesce(F.col("best.whole") | F.col("marked"), F.col("best.whole"), F.col("marked"), F.lit(False)).alias("whole"),
        F.col("best.license").alias("license"),
        (-F.col("best.far")).alias("similarity"),
    )


def directories(path: Column) -> Column:
    """All ancestor directories of a path, the nearest first; the top is the empty string."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )


def scan(files: DataFrame, *, path_col: str = "path", text_col: str = "text",
         templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every input row's columns with ``license``, ``similarity`` and ``inherited_from``.

    A file with a notice of its own has that license and a null ``inherited_from``.  Any other
    file takes the license of the nearest ancestor directory that holds a license file, and names
    the directory; a directory's license is that of its best license file, ties by path.  Files
    without either have nulls.  Null paths inherit nothing and find only their own notice, null
    texts are empty, rows that repeat a path share the best notice of them.  An empty table gives an
    empty result.  Clashing names get underscores in front.

    Inheritance is joined by directory, not by file: the distinct directories walk up to their
    ancestors, so a directory with a third of all files is one row.
    """
    license_, similarity, inherited = (fresh(files, c) for c in ("license", "similarity", "inherited_from"))
    key = fresh(files, "file_key")
    keyed = files.withColumn(key, F.coalesce(F.col(path_col), F.concat(F.lit("\0"), F.sha2(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))))
    own = settle(
        detect(keyed, path_col=key, text_col=text_col, templates=templates, threshold=threshold)
        .groupBy("path")
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license", "whole")).alias("top"))
        .select("path", (-F.col("top.s")).alias("own_similarity"),
                F.col("top.license").alias("own_license"), F.col("top.whole").alias("whole"))
    )
    nearest = directories(F.col("path"))[0]
    marked = (
        own.filter(F.col("whole") & ~F.col("path").startswith("\0"))
        .withColumn("dir", nearest)
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("own_similarity")).alias("s"), "path", "own_license")).alias("top"))
        .select("dir", F.col("top.own_license").alias("dir_license"), (-F.col("top.s")).alias("dir_similarity"))
    )
    at = F.element_at(directories(F.col(path_col)), 1)
    places = (
        files.select(at.alias("place")).filter("place IS NOT NULL").distinct()
        .select("place", F.posexplode(directories(F.concat("place", F.lit("/")))).alias("up", "dir"))
    )
    given = settle(
        places.join(marked, "dir")
        .groupBy("place")
        .agg(F.min(F.struct("up", "dir", "dir_license", "dir_similarity")).alias("near"))
        .select("place", "near.dir", "near.dir_license", "near.dir_similarity")
    )
    # what is found travels under names that the input does not have
    mine, near, place, own_path, at_place = (
        fresh(keyed, c) for c in ("own_notice", "near", "at_place", "own_path", "place")
    )
    found = keyed.join(
        own.select(
            F.col("path").alias(own_path),
            F.struct(
                F.col("own_license").alias("license"), F.col("own_similarity").alias("similarity")
            ).alias(mine),
        ),
        F.col(key) == F.col(own_path),
        "left",
    )
    placed = found.withColumn(place, at).join(
        given.select(
            F.col("place").alias(at_place),
            F.struct(
                "dir",
                F.col("dir_license").alias("license"),
                F.col("dir_similarity").alias("similarity"),
            ).alias(near),
        ),
        F.col(place) == F.col(at_place),
        "left",
    )
    given_by = F.col(near)["license"].isNotNull() & F.col(mine).isNull()
    return placed.select(
        *(F.col(c) for c in files.columns),
        F.coalesce(F.col(mine)["license"], F.col(near)["license"]).alias(license_),
        F.coalesce(F.col(mine)["similarity"], F.col(near)["similarity"]).alias(similarity),
        F.when(given_by, F.col(near)["dir"]).alias(inherited),
    )


QUERY = "op5_license_scan"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_terms(text: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex(lower({text}), {_quoted(_TERM)}), "
        "lambda w: regexp_replace(w, '^[.\\-]+|[.\\-]+$', '', 'g')), lambda w: w <> '')"
    )


def _sql_size(text: str) -> str:
    return f"len(list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> ''))"


_ROWS = ", ".join(
    f"({_quoted(f'{name} {k}')}, {_quoted(text)})" for k, (name, text) in enumerate(TEMPLATES)
)
SQL = f"""
WITH files AS (
  SELECT doc_id, coalesce(source, 'none') AS top,
         concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none')) AS dir,
         concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), doc_id) AS path,
         coalesce(text, '') AS text
  FROM documents),
noted AS (
  SELECT path, dir, text, array_to_string(list_filter(string_split(text, chr(10)),
           lambda l: regexp_matches(lower(l), {_quoted(NOTICE)})), chr(10)) AS notice
  FROM files WHERE regexp_matches(lower(text), {_quoted(NOTICE)})),
words AS (
  SELECT path, term, count(*) AS tf
  FROM (SELECT path, unnest({_sql_terms('notice')}) AS term FROM noted) GROUP BY ALL),
templates(template, text) AS (VALUES {_ROWS}),
wanted AS (
  SELECT template, term, count(*) AS tf
  FROM (SELECT template, unnest({_sql_terms('text')}) AS term FROM templates) GROUP BY ALL),
total AS (SELECT (SELECT count(*) FROM noted) + (SELECT count(*) FROM templates) AS n),
idf AS (
  SELECT term, ln((n + 1) / (count(*) + 1)) + 1 AS idf
  FROM (SELECT term FROM words UNION ALL SELECT term FROM wanted), total GROUP BY term, n),
a AS (SELECT path, term, (1 + ln(tf)) * idf AS w FROM words JOIN idf USING (term)),
b AS (SELECT template, term, (1 + ln(tf)) * idf AS w FROM wanted JOIN idf USING (term)),
an AS (SELECT path, sqrt(sum(w * w)) AS norm FROM a GROUP BY path),
bn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM b GROUP BY template),
cosine AS (
  SELECT path, template, round(sum(a.w / an.norm * (b.w / bn.norm)), 6) AS similarity
  FROM a JOIN an USING (path) JOIN b USING (term) JOIN bn USING (template) GROUP BY ALL),
own AS (
  SELECT path, string_split(template, ' ')[1] AS license, similarity FROM cosine
  WHERE similarity >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY similarity DESC, template) = 1),
marked AS (
  SELECT dir, license, similarity FROM own JOIN noted USING (path)
  WHERE {_sql_size('notice')} >= {WHOLE_FILE} * {_sql_size('text')}
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY similarity DESC, path) = 1)
SELECT f.doc_id, f.path, coalesce(own.license, near.license) AS license,
       coalesce(own.similarity, near.similarity) AS similarity,
       CASE WHEN own.path IS NULL THEN near.dir END AS inherited_from
FROM files f LEFT JOIN own ON own.path = f.path LEFT JOIN marked near ON near.dir = f.dir
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all ``documents`` as files ``source/lang/doc_id``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id"))
    return scan(docs.select("doc_id", path.alias("path"), "text")).drop("text")
