"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

Templates are partitioned by their number of five-word shingles into classes ``[m, 2m)``. For a class a text is cut
into windows of ``4m`` shingles that begin every ``2m``, so a passage as long as a template of the class lies in one
window whole. A window that holds ``THRESHOLD`` of a template has a Jaccard similarity to it of at least
``floor = t / (4 + 1 - t)``, and ``bands`` one-row bands collide with probability 1 - (1 - floor)^bands >= RECALL.

A band of a window can equal a template's only if the window holds that template's smallest shingle in the band's
order. The scan therefore first looks each shingle up among these smallest shingles, which are few, and computes
bands only for windows that hold one; no window with a collision is left out. Retrieved pairs are verified by the
exact share of the template's shingles that the window holds.

All of it is DataFrame functions: texts are never shuffled, and only verified rows are exchanged. The templates'
size is checked (``MAX_TEMPLATE_BYTES``) before their bands go into the plan.

A row of the result is a text and a template with the largest containment over its windows and the word at which
the first such window begins. Null and empty texts and texts of fewer than five words give none. Repeated rows (id
and text) give one. A template of fewer than five words is refused by ``scan_licenses``; ``scan_notices`` takes it as one
shingle of its own length, which a text holds or doesn't. An empty table gives an empty result; columns
besides id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import prepare, table

K, THRESHOLD, RECALL = 5, 0.8, 0.9999
MAX_TEMPLATE_BYTES = 1 << 20
FLOOR = THRESHOLD / (4 + 1 - THRESHOLD)
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - FLOOR))

#: Notices and grants as their publishers word them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "mit-notice": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Notices of fewer than K words.
SHORT = {"all-rights-reserved": "All rights reserved."}


def words(text: Column) -> Column:
    """The letters, marks and digits of the lower-cased text, in runs."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda w: w != "")


def with_shingles(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with hashes of all runs of K words of ``text``, in order: each hash covers the hashes of its words.

    The words' hashes are a column of their own, used several times, so the plan computes them once a row.
    """
    hashed = df.withColumn("__h", F.transform(words(F.col(text)), lambda x: F.xxhash64(x)))
    runs = F.transform(F.sequence(F.lit(0), F.size("__h") - K), lambda i: F.xxhash64(*(F.get("__h", i + j) for j in range(K))))
    return hashed.withColumn(out, F.when(F.size("__h") >= K, runs).otherwise(F.array().cast("array<long>"))).drop("__h")


def bands(window: Column) -> Column:
    """For each band a hash of its number and of the smallest shingle of a window in the band's order."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(F.array_min(F.transform(window, lambda x: F.xxhash64(x, b))), b))


def _windows(step: int) -> Callable[[Column], Column]:
    """The two windows of a class that hold a place (the earlier may not exist)."""
    whole = lambda i: F.floor(i / step).cast("int") * step
    return lambda i: F.array(*(F.struct(F.lit(step).alias("step"), (whole(i) - back).alias("start")) for back in (0, step)))


def template_table(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Each template's ``size`` class, distinct shingles ``s``, ``bands`` and each band's ``smallest`` shingle."""
    if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
        raise ValueError(f"the templates exceed {MAX_TEMPLATE_BYTES} bytes")
    given = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    own = with_shingles(given, "text", "s").select("template", F.array_distinct("s").alias("s"))
    own = own.withColumn("bands", bands(F.col("s")))
    smallest = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform("s", lambda x: F.struct(F.xxhash64(x, b).alias("low"), x.alias("shingle"))))["shingle"])
    out = [r.asDict() for r in own.withColumn("smallest", smallest).collect()]
    for r in out:
        if not r["s"]:
            raise ValueError(f"template {r['template']!r} has fewer than {K} words")
        r["size"] = 1 << (len(r["s"]).bit_length() - 1)
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """``id_col``, ``template``, ``containment``, ``word`` of all texts that hold a template."""
    spark = prepare(docs.sparkSession)
    known = template_table(spark, TEMPLATES if templates is None else templates)
    smallest = sorted({x for r in known for x in r["smallest"]})
    given = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(F.col(f"`{text_col}`")).alias("__text"), F.col(f"`{text_col}`").alias("__t"))
    cut = with_shingles(given, "__t", "__s").drop("__t")
    marked = cut.withColumn("__at", F.filter(F.transform("__s", lambda x, i: F.when(x.isin(smallest), i)), lambda i: i.isNotNull()))
    # No filter on __at: pushed below the columns it stands on, it would compute them anew for each shingle. Explode drops what has none.
    steps = sorted({2 * r["size"] for r in known})
    windows = marked.withColumn("__win", F.explode(F.array_distinct(F.flatten(F.array(*(F.flatten(F.transform("__at", _windows(step))) for step in steps))))))
    step, start = F.col("__win.step"), F.col("__win.start")
    held = windows.filter(start >= 0).select("__id", "__text", step.alias("step"), start.cast("long").alias("word"), F.slice("__s", start + 1, 2 * step).alias("__win"))
    lows = held.withColumn("__bands", bands(F.col("__win")))
    hits = []
    for r in known:
        collide = F.arrays_overlap("__bands", F.array(*map(F.lit, r["bands"])))
        share = F.size(F.array_intersect("__win", F.array(*map(F.lit, r["s"])))) / len(r["s"])
        hits.append(F.when((F.col("step") == 2 * r["size"]) & collide, F.struct(F.lit(r["template"]).alias("template"), share.alias("share"))))
    every = lows.select("__id", "__text", "word", F.explode(F.array(*hits)).alias("hit")).filter(F.col("hit").isNotNull() & (F.col("hit.share") >= THRESHOLD - 1e-9))
    best = every.groupBy("__id", "__text", F.col("hit.template").alias("template")).agg(F.max(F.struct(F.col("hit.share").alias("share"), (-F.col("word")).alias("back"))).alias("best"))
    return best.select(F.col("__id").alias(id_col), "template", F.round("best.share", 6).alias("containment"), (-F.col("best.back")).alias("word"))


def scan_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``scan_licenses``, and the same for templates of fewer than K words, of which texts hold all words in order."""
    spark = prepare(docs.sparkSession)
    templates = TEMPLATES | SHORT if templates is None else templates
    given = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    known = [r for r in given.select("template", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h")).collect() if len(r.h) < K]
    if any(not r.h for r in known):
        raise ValueError("a template has no words")
    rest = {k: t for k, t in templates.items() if k not in {r.template for r in known}}
    parts = [scan_licenses(docs, id_col, text_col, rest)] if rest or not known else []
    if known:
        hashed = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(F.col(f"`{text_col}`")).alias("__text"), F.transform(words(F.col(f"`{text_col}`")), lambda x: F.xxhash64(x)).alias("__h"))
        at = lambda h: F.filter(F.transform("__h", lambda x, i: F.when(F.slice("__h", i + 1, len(h)) == F.array(*map(F.lit, h)), i)) if len(h) > 1 else F.transform("__h", lambda x, i: F.when(x == h[0], i)), lambda i: i.isNotNull())
        hits = [F.struct(F.lit(r.template).alias("template"), F.array_min(at(r.h)).cast("long").alias("word")) for r in known]
        found = hashed.select("__id", "__text", F.explode(F.array(*hits)).alias("hit")).filter(F.col("hit.word").isNotNull())
        first = found.groupBy("__id", "__text", F.col("hit.template").alias("template")).agg(F.min("hit.word").alias("word"))
        parts.append(first.select(F.col("__id").alias(id_col), "template", F.lit(1.0).alias("containment"), "word"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def op4_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_notices(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in TEMPLATES.items())
    return rf"""
WITH t(template, text) AS (VALUES {quoted}),
w AS (SELECT 1 AS kind, NULL AS id, template, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM t
      UNION ALL SELECT DISTINCT 0, doc_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') FROM documents),
s AS (SELECT kind, id, template AS name, unnest(list_transform(range(1, len(w) - {K - 2}), lambda i: array_to_string(w[i:i + {K - 1}], ' '))) AS s, unnest(range(0, len(w) - {K - 1})) AS pos FROM w WHERE len(w) >= {K}),
q AS (SELECT DISTINCT name AS template, s, count(DISTINCT s) OVER (PARTITION BY name) AS n FROM s WHERE kind = 1),
z AS (SELECT template, s, n, 2 * (1 << floor(log2(n))::INTEGER) AS step FROM q),
m AS (SELECT id, name, template, n, step, s, unnest([pos // step, pos // step - 1]) AS win FROM (SELECT s.id, s.name, z.template, z.n, z.step, s.s, s.pos FROM s JOIN z USING (s) WHERE kind = 0)),
c AS (SELECT id, name, template, win * step AS word, count(DISTINCT s) / n AS share FROM m WHERE win >= 0 GROUP BY id, name, template, win, step, n HAVING count(DISTINCT s) >= {THRESHOLD} * n - 1e-9)
SELECT id AS doc_id, template, round(max(share), 6) AS containment, min(word) FILTER (share = top)::BIGINT AS word
FROM (SELECT *, max(share) OVER (PARTITION BY id, name, template) AS top FROM c) GROUP BY id, name, template
"""


QUERIES = {"op4_license_scan": op4_license_scan, "op4_license_notices": op4_license_notices}
ORACLES = {"op4_license_scan": _sql()}
