"""License scan: TF-IDF cosine to templates, inherited along directories.

Units are compared with the templates' word vectors: every header line of a
file (a line that names a licence, by ``ANCHORS``) and, of licence files (by
their name), the whole text. Inverse document frequencies of the templates'
words are counted over all files. A word that no template has weighs as much as
a word seen in no file, each occurrence for itself. A unit's licence is the
template of the largest cosine, from ``threshold`` up; a file's own licence is
that of its best unit.

Beside the notices a licence has an SPDX identifier, its full text and the
usual header of a source file. An SPDX line's identifiers are looked up by name;
licence files' whole texts are compared with the full texts, and each header
line, with the two lines after it, with the headers. These templates also cover
licences that resemble one of the notices', so that GPL 2 is not taken for
GPL 3. An SPDX line decides (of several identifiers the first licence by name),
then a full text, else the best of notices and headers, at a tie the notice.

All identifiers of a file's SPDX lines, those of no known licence and of
expressions too (``A OR B``), are in the result as they come.

A file without an own licence inherits that of the nearest directory at or above
its own which holds a licence file with a licence: directories (not files) are
joined by path prefixes, then files take their directory's answer.

Only DataFrame functions run. What is shuffled are counts of template words, and
paths; texts stay where they were read. Templates (a fixed list) and their
vectors are broadcast.

Defined cases: null text is the empty text, without a licence; a null path has
no directory and inherits nothing; rows that repeat are judged each; ties of
cosine go to the licence first by name, of licence files in one directory to
the first path; an empty table gives none; other columns are ignored but ``id``.
"""

from __future__ import annotations

from functools import lru_cache
from importlib.resources import files as package_files

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import stored, text_of

#: Notices by licence. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD License.",
    "CC-BY-4.0": "This work is licensed under CC BY 4.0, the Creative Commons Attribution License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved.",
    "Public-Domain": "This work is released into the public domain under the Unlicense.",
}
#: Words of which a header line has one.
ANCHORS = "licen[sc]e|unlicense|copyright|rights reserved|public domain|redistribution|spdx"
#: File names of licence files.
LICENCE_FILE = r"^(licen[sc]e|copying|notice|unlicense)(\.[a-z]+)?$"
#: Full texts in ``license_texts``, by their licence.
FULL_TEXTS = {
    "Apache-2.0": "Apache-2.0",
    "BSD-2-Clause": "BSD-2-Clause",
    "BSD-3-Clause": "BSD-3-Clause",
    "CC0-1.0": "Public-Domain",
    "GPL-2.0": "GPL-2.0",
    "GPL-3.0": "GPL-3.0",
    "ISC": "ISC",
    "LGPL-2.1": "LGPL-2.1",
    "LGPL-3.0": "LGPL-3.0",
    "MIT": "MIT",
    "MPL-2.0": "MPL-2.0",
    "Unlicense": "Public-Domain",
}
_GNU = "it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
_CC = "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons {} 4.0 International Public License"
_CC_LINK = "This work is licensed under a Creative Commons {} 4.0 International License"
_CC_KINDS = {
    "CC-BY-4.0": "Attribution",
    "CC-BY-NC-4.0": "Attribution-NonCommercial",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
    "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-ND-4.0": "Attribution-NoDerivatives",
    "CC-BY-SA-4.0": "Attribution-ShareAlike",
}
#: Three lines of source headers, (licence, text).
HEADERS = [
    ("AGPL-3.0", _GNU.format("Affero General Public License", 3)),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("GPL-2.0", _GNU.format("General Public License", 2)),
    ("GPL-3.0", _GNU.format("General Public License", 3)),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", 3)),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Public-Domain", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    *((k, t.format(v)) for k, v in _CC_KINDS.items() for t in (_CC, _CC_LINK)),
]
#: Phrases of which the first of such three lines has one.
HEADER_ANCHORS = ANCHORS + "|permission is hereby granted|permission to use, copy|source code form|gnu (affero|lesser)? ?general public"
#: Licences by SPDX identifier, in lower case.
SPDX = {
    **{x.lower(): x for x in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "MPL-2.0", *_CC_KINDS)},
    **{f"{x}{y}".lower(): x for x in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0") for y in ("", "+", "-only", "-or-later")},
    **{x.lower(): x for x in ("0BSD", "Artistic-2.0", "BSL-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "MIT-0", "NCSA", "PostgreSQL", "Python-2.0", "WTFPL", "Zlib")},
    "unlicense": "Public-Domain",
    "cc0-1.0": "Public-Domain",
}
#: Words of an SPDX expression that are no identifiers.
SPDX_OPERATORS = ("or", "and", "with")
SPDX_LINE = r"(?i)spdx-license-identifier:[ \t]*([^\n]*)"
THRESHOLD = 0.6
WORD = r"[\p{L}\p{N}]+"


def template_words(spark) -> DataFrame:
    """(license, word, tf)."""
    rows = spark.createDataFrame(sorted(TEMPLATES.items()), "license string, t string")
    return rows.select("license", F.explode(_words("t")).alias("word")).groupBy("license", "word").agg(F.count("*").alias("tf"))


@lru_cache(1)
def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the full texts."""
    folder = package_files("caldim.llm") / "license_texts"
    texts = [(name, (folder / f"{file}.txt").read_text()) for file, name in FULL_TEXTS.items()]
    # the AGPL differs from the GPL by its name, and by a section and a paragraph on use over a network
    gpl = dict(texts)["GPL-3.0"]
    agpl = gpl.replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")
    return [*texts, ("AGPL-3.0", agpl)]


def _known(templates: list[tuple[str, str]]):
    """The distinct words of templates, as an array column."""
    return F.array_distinct(_words(F.lit("\n".join(t for _, t in templates))))


def _likest(units: DataFrame, templates: list[tuple[str, str]], df: DataFrame, n: int, threshold: float) -> DataFrame:
    """(row, license, score) of the rows of ``units`` (row, words: units of the
    row, each an array of words) whose best unit has a cosine from ``threshold``
    up to one of ``templates``."""
    spark = units.sparkSession
    rows = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(templates)], "k int, t string")
    tf = rows.select("k", F.explode(_words("t")).alias("word")).groupBy("k", "word").agg(F.count("*").alias("tf"))
    weight = F.log(F.lit(1.0 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1
    t = tf.join(F.broadcast(df), "word", "left").withColumn("idf", weight).withColumn("x", F.col("tf") * F.col("idf"))
    norms = t.groupBy("k").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    y = t.join(F.broadcast(norms), "k").withColumn("y", F.col("x") / F.col("norm"))
    # one row a word, a column a template: a unit's words meet all templates without more rows
    wide = y.groupBy("word", "idf").agg(*(F.sum(F.when(F.col("k") == k, F.col("y")).otherwise(0.0)).alias(f"y{k}") for k in range(len(templates))))
    rare = F.log(F.lit(1.0 + n)) + 1
    words = units.select("row", F.posexplode("words").alias("unit", "w")).select("row", "unit", F.explode("w").alias("word"))
    counts = (
        words.join(F.broadcast(t.select("word").distinct().withColumn("known", F.lit(True))), "word", "left")
        .groupBy("row", "unit", F.when(F.col("known"), F.col("word")).alias("word"))
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(wide), "word", "left")
    )
    square = F.when(F.col("word").isNull(), F.col("tf") * rare * rare).otherwise(F.pow(F.col("tf") * F.col("idf"), F.lit(2)))
    dots = [F.sum(F.col("tf") * F.col("idf") * F.col(f"y{k}")).alias(f"d{k}") for k in range(len(templates))]
    judged = counts.groupBy("row", "unit").agg(F.sqrt(F.sum(square)).alias("norm"), *dots)
    scores = (F.struct((-F.round(F.col(f"d{k}") / F.col("norm"), 6)).alias("s"), F.lit(name).alias("license")) for k, (name, _) in enumerate(templates))
    best = judged.select("row", F.array_min(F.array(*scores)).alias("b")).filter(-F.col("b.s") >= threshold)
    return best.groupBy("row").agg(F.min("b").alias("b")).select("row", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def _words(col):
    return F.regexp_extract_all(F.lower(col), F.lit(f"({WORD})"), F.lit(1))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, path, own_license, own_score, license, license_dir, spdx) of every
    file; ``files`` has id, path and text. license is the own or inherited one,
    license_dir the directory that it was inherited from, spdx the identifiers
    of SPDX lines, joined by commas."""
    spark = files.sparkSession
    base = files.select("id", F.col("path").cast("string").alias("path"), text_of().alias("text"))
    full = full_texts()
    known = _known([*TEMPLATES.items(), *HEADERS, *full])
    name = F.lower(F.element_at(F.split("path", "/", -1), -1))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.lower(x).rlike(ANCHORS))
    whole = F.coalesce(name.rlike(LICENCE_FILE), F.lit(False))
    # matches of no width, so that each header line starts three lines of its own
    three = F.regexp_extract_all("text", F.lit(rf"(?imd)^(?=([^\n]*(?:{HEADER_ANCHORS})[^\n]*(?:\n[^\n]*){{0,2}}))"), F.lit(1))
    met = F.transform(F.regexp_extract_all("text", F.lit(SPDX_LINE), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit("([A-Za-z0-9.+-]+)"), F.lit(1)))
    met = F.array_distinct(F.filter(F.flatten(met), lambda x: ~F.lower(x).isin(*SPDX_OPERATORS)))
    named = F.transform(met, lambda x: F.try_element_at(F.create_map(*(F.lit(v) for kv in SPDX.items() for v in kv)), F.lower(x)))
    # one pass over the texts: what is written has header lines, licence files' counts and each file's template words
    read = base.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "path",
        whole.alias("is_file"),
        F.array_intersect(known, _words("text")).alias("seen"),
        lines.alias("headers"),
        F.when(whole, _words("text")).alias("all_words"),
        F.when(F.col("text").rlike(f"(?i){HEADER_ANCHORS}"), three).otherwise(F.array().cast("array<string>")).alias("three"),
        F.when(F.col("text").rlike(SPDX_LINE), F.struct(F.array_min(named).alias("license"), F.array_join(met, ",").alias("ids"))).alias("spdx"),
    )
    per_file = F.when(F.col("is_file"), F.array(F.col("all_words"))).otherwise(F.array().cast("array<array<string>>"))
    units = F.concat(per_file, F.transform("headers", lambda x: _words(x)))
    threes = F.transform("three", lambda x: _words(x))
    marked = stored(read.select("row", "id", "path", "is_file", "seen", units.alias("units"), threes.alias("threes"), "spdx"), "license-units")

    n = marked.count()
    df = marked.select(F.explode("seen").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    t = template_words(spark).join(F.broadcast(df), "word", "left")
    weight = F.log(F.lit(1.0 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1
    t = t.select("license", "word", "tf", weight.alias("idf"))
    t = t.withColumn("x", F.col("tf") * F.col("idf"))
    norms = t.groupBy("license").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    vectors = t.join(F.broadcast(norms), "license").select("license", "word", (F.col("x") / F.col("norm")).alias("y"))
    idf = t.select("word", "idf").distinct()
    rare = F.log(F.lit(1.0 + n)) + 1

    words = marked.select("row", F.posexplode("units").alias("unit", "w")).select("row", "unit", F.explode("w").alias("word"))
    counts = (
        words.join(F.broadcast(idf), "word", "left")
        .groupBy("row", "unit", F.when(F.col("idf").isNotNull(), F.col("word")).alias("word"), "idf")
        .agg(F.count("*").alias("tf"))
    )
    sized = counts.withColumn(
        "square", F.when(F.col("word").isNull(), F.col("tf") * rare * rare).otherwise(F.pow(F.col("tf") * F.col("idf"), F.lit(2)))
    )
    norm = sized.groupBy("row", "unit").agg(F.sqrt(F.sum("square")).alias("norm"))
    dots = (
        sized.join(F.broadcast(vectors), "word").groupBy("row", "unit", "license").agg(F.sum(F.col("tf") * F.col("idf") * F.col("y")).alias("dot"))
    )
    cosine = dots.join(norm, ["row", "unit"]).select("row", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    best = (
        cosine.filter(F.col("score") >= threshold)
        .groupBy("row")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
        .select("row", F.col("b.license").alias("own_license"), (-F.col("b.s")).alias("own_score"))
    )
    parent = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    files_words = marked.filter("is_file").select("row", F.slice("units", 1, 1).alias("words"))
    texts = _likest(files_words, full, df, n, threshold).select("row", F.struct("license", "score").alias("by_text"))
    header = _likest(marked.select("row", F.col("threes").alias("words")), HEADERS, df, n, threshold)
    header = header.select("row", F.struct("license", "score").alias("by_header"))
    spdx = F.when(F.col("spdx.license").isNotNull(), F.struct(F.col("spdx.license").alias("license"), F.lit(1.0).alias("score")))
    notice = F.when(F.col("own_license").isNotNull(), F.struct(F.col("own_license").alias("license"), F.col("own_score").alias("score")))
    better = F.when(F.col("own_score").isNull() | (F.col("by_header.score") > F.col("own_score")), F.col("by_header"))
    judged = marked.select("row", "id", "path", "is_file", parent.alias("dir"), "spdx")
    for found in (best, texts, header):
        judged = judged.join(found, "row", "left")
    own = F.coalesce(spdx, "by_text", better, notice)
    ids = F.when(F.col("spdx.ids") != "", F.col("spdx.ids")).alias("spdx")
    judged = judged.select("row", "id", "path", "is_file", "dir", ids, own["license"].alias("own_license"), own["score"].alias("own_score"))
    judged = stored(judged, "license-own")

    holders = (
        judged.filter("is_file and own_license is not null")
        .groupBy(F.col("dir").alias("above"))
        .agg(F.min(F.struct("path", "own_license")).alias("m"))
        .select("above", F.col("m.own_license").alias("held"))
    )
    nodes = F.split("dir", "/", -1)
    prefixes = F.transform(F.sequence(F.lit(0), F.size(nodes)), lambda k: F.array_join(F.slice(nodes, 1, k), "/"))
    dirs = judged.filter("own_license is null and dir is not null").select("dir").distinct()
    above = dirs.select("dir", F.explode(F.array_distinct(prefixes)).alias("above"))
    nearest = (
        above.join(holders, "above")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "held")).alias("m"))
        .select("dir", F.col("m.above").alias("from_dir"), F.col("m.held").alias("held"))
    )
    taken = judged.join(nearest, "dir", "left")
    own = F.col("own_license").isNotNull()
    return taken.select(
        "id",
        "path",
        "own_license",
        "own_score",
        F.coalesce("own_license", "held").alias("license"),
        F.when(~own, F.col("from_dir")).alias("license_dir"),
        "spdx",
    )


def oracle_sql(files: str, threshold: float = THRESHOLD) -> str:
    """The scan by notices and SPDX lines over ``files``, SQL that gives id, path and text."""
    known = ", ".join(f"('{k}', '{v}')" for k, v in SPDX.items())
    operators = ", ".join(f"'{x}'" for x in SPDX_OPERATORS)
    line = SPDX_LINE.replace("[ \\t]", "[ \t]").replace("[^\\n]", "[^\n]")
    templates = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in TEMPLATES.items())

    def words(of: str) -> str:
        return f"regexp_extract_all(lower({of}), '{WORD}')"

    return f"""
    WITH f AS (SELECT id, path, coalesce(text, '') AS text, regexp_replace(path, '/[^/]*$', '') AS dir,
        regexp_matches(lower(string_split(path, '/')[-1]), '{LICENCE_FILE}') AS whole FROM ({files})),
    tw AS (SELECT license, word, count(*) AS tf FROM (
        SELECT license, unnest({words("t")}) AS word FROM (VALUES {templates}) v(license, t)) GROUP BY ALL),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM f),
    df AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT id, unnest({words("text")}) AS word FROM f)
        WHERE word IN (SELECT word FROM tw) GROUP BY word),
    idf AS (SELECT DISTINCT word, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM tw LEFT JOIN df USING (word), n),
    norm AS (SELECT license, sqrt(sum((tf * idf) * (tf * idf))) AS norm FROM tw JOIN idf USING (word) GROUP BY license),
    vec AS (SELECT license, word, tf * idf / norm AS y FROM tw JOIN idf USING (word) JOIN norm USING (license)),
    units AS (
      SELECT id, 0 AS unit, text AS u FROM f WHERE whole UNION ALL
      SELECT id, i AS unit, ls[i] AS u FROM (SELECT id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
        SELECT id, string_split(text, chr(10)) AS ls FROM f)) WHERE regexp_matches(lower(ls[i]), '{ANCHORS}')),
    uw AS (SELECT id, unit, unnest({words("u")}) AS word FROM units),
    c AS (SELECT id, unit, word, idf, count(*) AS tf FROM uw LEFT JOIN idf USING (word) GROUP BY ALL),
    un AS (SELECT id, unit, sqrt(sum(CASE WHEN idf IS NULL THEN tf * (ln(1 + n) + 1) * (ln(1 + n) + 1)
        ELSE (tf * idf) * (tf * idf) END)) AS norm FROM c, n GROUP BY id, unit),
    s AS (SELECT id, unit, license, sum(tf * idf * y) AS dot FROM c JOIN vec USING (word) GROUP BY ALL),
    best AS (SELECT id, license, round(dot / norm, 6) AS score FROM s JOIN un USING (id, unit)
      WHERE round(dot / norm, 6) >= {threshold} QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(dot / norm, 6) DESC, license) = 1),
    ids AS (SELECT id, found AS met FROM (
      SELECT id, list_filter(flatten(list_transform(regexp_extract_all(text, '{line}', 1), lambda x: regexp_extract_all(x, '[A-Za-z0-9.+-]+'))),
        lambda x: lower(x) NOT IN ({operators})) AS found FROM f)),
    spdx AS (
      SELECT id, (SELECT min(v.license) FROM (VALUES {known}) v(name, license) WHERE list_contains(list_transform(met, lambda x: lower(x)), v.name)) AS named,
        CASE WHEN len(met) > 0 THEN array_to_string(list_filter(met, lambda x, i: list_position(met, x) = i), ',') END AS spdx
      FROM ids),
    own AS (SELECT f.id, path, dir, whole, coalesce(named, license) AS license, CASE WHEN named IS NULL THEN score ELSE 1.0 END AS score, spdx
      FROM f LEFT JOIN best USING (id) JOIN spdx USING (id)),
    holder AS (SELECT dir AS above, arg_min(license, path) AS held FROM own WHERE whole AND license IS NOT NULL GROUP BY dir),
    nearest AS (SELECT d.dir, arg_max(above, length(above)) AS from_dir, arg_max(held, length(above)) AS held
      FROM (SELECT DISTINCT dir FROM own) d JOIN holder ON d.dir = above OR starts_with(d.dir, above || '/') OR above = '' GROUP BY d.dir)
    SELECT own.id AS doc_id, path, license AS own_license, score AS own_score, coalesce(license, held) AS license,
           CASE WHEN license IS NULL THEN from_dir END AS license_dir, spdx
    FROM own LEFT JOIN nearest USING (dir)"""
