"""Licence scans by the Dice coefficient over word bigrams.

A document's units are its lines, its paragraphs of several lines (between blank
lines) and, if it has several paragraphs, its whole text. A unit and a template
are compared by the distinct bigrams of their normalised words (lower case, runs
of other characters than a-z and 0-9 between words):

    dice = 2 |A n B| / (|A| + |B|)

A template is a candidate only where the sizes allow the threshold, that is
2 min(|A|, |B|) >= threshold (|A| + |B|). Before any bigram is made, units are
dropped that hold none of the templates' key words; key words are chosen so that
too few bigrams of each template are free of them to reach the threshold, so
nothing is lost. Everything is DataFrame functions; the templates are fixed.

With ``windows``, licences inside a unit or over several are found too: by the
windows of a document's words that are as long as a template, at every word, over
the templates and the full licence texts of ``licence_texts``. Here bigrams that
the template does not have count as often as they come, and a document that is
shorter than the window is one. From the best on, a window is one more unit unless
it overlaps a better one of its licence family, or the document's units have its
licence with as good a coefficient. A document is looked at if it holds a key word
of these templates.

Cases: null and empty texts and units of fewer than two words match nothing;
long texts are units as a whole; equal scores go to the first licence by name;
what is found belongs to a row's id and text, so rows without id keep apart, and rows
that repeat both have the same result; an empty table gives no rows; other columns are not returned.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.llm.store import registry, text_of

THRESHOLD = 0.7

QUERIES, ORACLE, query = registry()

# fixed values: texts of public licences and usual notices
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Proprietary", "All rights reserved."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
]
# fixed values: words too common to be key words
COMMON = set("a above all an and any appear are as at be by can do either following for form forms free if in into is it later list may met must not of on one or other out so that the this to under use was whom with without work you 1 2 3".split())
# fixed values: further words of licence texts that are usual elsewhere
USUAL = COMMON | set("also been but could does each from had has have he her his how i its make more no only our own she should some such than their them then there these they those through up we were what when where which who will would your".split())


# fixed values: notices compared with windows only
NOTICES = [
    (
        name,
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License "
        f"as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
    )
    for name, what, kind, version in [("GPL-2.0", "program", "", "2"), ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "library", "Lesser ", "3")]
]


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the whole licences."""
    return [(f.stem, f.read_text(encoding="utf-8")) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]


def family(licence: Column) -> Column:
    """BSD, GPL, CC and so on: the name up to its first hyphen; LGPL is GPL."""
    return F.regexp_replace(F.substring_index(licence, "-", 1), "^LGPL", "GPL")


def plain_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def key_words(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, common: set[str] = COMMON) -> list[str]:
    """Words of which every unit that reaches the threshold with some template holds at least one.

    Such a unit shares threshold |B| / (2 - threshold) bigrams at least, so words are taken until fewer are free of them.
    """
    keys: set[str] = set()
    for _, text in templates:
        words = plain_words(text)
        bigrams = set(zip(words, words[1:]))
        least = threshold * len(bigrams) / (2 - threshold)
        while len(free := [b for b in bigrams if not keys.intersection(b)]) >= least:
            counts = Counter(w for b in free for w in set(b) if w not in common)
            if not counts:
                raise ValueError(f"too few uncommon words in template {text[:40]!r}")
            keys.add(max(sorted(counts), key=counts.get))
    return sorted(keys)


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def bigrams_of(words: Column) -> Column:
    """Distinct pairs of neighbouring words (two words at least)."""
    pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def template_bigrams(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(licence, template, length, n_template, bigram) of the fixed templates."""
    rows = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(k).alias("template"), F.lit(text).alias("text")) for k, (name, text) in enumerate(templates)])
    words = words_of(F.col("text"))
    found = spark.range(1).select(F.inline(rows)).select("licence", "template", bigrams_of(words).alias("bigrams"), (F.size(words) - 1).alias("length"))
    return found.select("licence", "template", "length", F.size("bigrams").alias("n_template"), F.explode("bigrams").alias("bigram"))


def units(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, key, kind, at, text), ``key`` a hash of the row's text: lines, paragraphs of several lines, and texts of several paragraphs."""
    body = text_of(docs, text)
    part = lambda kind, at, x: F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), x.alias("text"))
    lines = F.transform(F.split(body, "\n"), lambda x, i: part("line", i, x))
    paragraphs = F.split(body, r"\n[ \t\r]*\n")
    several = F.filter(F.transform(paragraphs, lambda x, i: part("paragraph", i, x)), lambda p: F.contains(p["text"], F.lit("\n")))
    whole = F.filter(F.array(part("text", F.lit(0), body)), lambda p: F.size(paragraphs) > 1)
    rows = docs.select(F.col(id).alias("doc_id"), F.xxhash64(body).alias("key"), F.explode(F.concat(lines, several, whole)).alias("unit"))
    return rows.select("doc_id", "key", "unit.*")


def matches(docs: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, key, kind, at, licence, dice) of the units that reach the threshold with a template, the best template of each licence.

    Rows that repeat an id and a text have their units in common.
    """
    words = words_of(F.col("text"))
    keys = F.array(*[F.lit(w) for w in key_words(threshold=threshold)])
    found = units(docs, text, id).where(F.arrays_overlap(words, keys)).select("doc_id", "key", "kind", "at", bigrams_of(words).alias("bigrams"))
    found = found.withColumn("n", F.size("bigrams")).select("doc_id", "key", "kind", "at", "n", F.explode("bigrams").alias("bigram"))
    templates = F.broadcast(template_bigrams(docs.sparkSession))  # fixed
    sizes_allow = 2 * F.least("n", "n_template") >= threshold * (F.col("n") + F.col("n_template"))
    shared = found.join(templates, "bigram").where(sizes_allow)
    # at most a template's bigrams
    dice = (2.0 * F.size(F.collect_set("bigram")) / (F.col("n") + F.col("n_template"))).alias("dice")
    scored = shared.groupBy("doc_id", "key", "kind", "at", "licence", "template", "n", "n_template").agg(dice)
    return scored.where(F.col("dice") >= threshold).groupBy("doc_id", "key", "kind", "at", "licence").agg(F.max("dice").alias("dice"))


def window_matches(docs: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, key, kind, at, licence, dice) of the best windows of each row that overlap no better one of their licence family; ``at`` counts words."""
    templates = TEMPLATES + NOTICES + full_texts()
    keys = F.array(*[F.lit(w) for w in key_words(templates, threshold, USUAL)])
    body = text_of(docs, text)
    own = docs.select(F.struct(F.col(id).alias("doc_id"), F.xxhash64(body).alias("key")).alias("of"), words_of(body).alias("words")).where(F.arrays_overlap("words", keys))
    own = own.withColumn("n_words", F.size("words")).where("n_words > 1").withColumn("row", F.monotonically_increasing_id())
    pairs = F.zip_with(F.slice("words", F.lit(1), F.col("n_words") - 1), F.slice("words", F.lit(2), F.col("n_words") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    own = own.select("row", "of", F.col("n_words").alias("_words"), F.posexplode(pairs).alias("pos", "bigram"))
    wanted = template_bigrams(docs.sparkSession, templates).withColumn("code", F.xxhash64("bigram"))
    own = own.join(F.broadcast(wanted), "bigram").select("row", "of", "_words", "licence", "template", "length", "n_template", "code", "pos")  # fixed
    # at most so many of a document's bigrams are a template's: no window of it can reach the threshold
    seen = W.partitionBy("row", "template")
    own = own.repartition("row", "template").withColumn("before", F.lag("pos").over(W.partitionBy("row", "template", "code").orderBy("pos")))
    own = own.withColumn("distinct", F.count(F.when(F.col("before").isNull(), 1)).over(seen))
    own = own.where(F.col("distinct") * (2 - threshold) >= threshold * F.col("n_template"))
    # an occurrence is its bigram's first in the windows that begin after the one before it
    start = F.greatest(F.lit(0), F.col("pos") - F.col("length") + 1)
    step = lambda at, shared, hits: F.struct(at.alias("at"), F.lit(shared).alias("shared"), F.lit(hits).alias("hits"))
    steps = F.array(step(F.greatest(start, F.coalesce(F.col("before") + 1, F.lit(0))), 1, 0), step(start, 0, 1), step(F.col("pos") + 1, -1, -1))
    steps = own.select("row", "of", "_words", "licence", "template", "length", "n_template", F.inline(steps))
    so_far = W.partitionBy("row", "template").orderBy("at")
    steps = steps.withColumn("shared", F.sum("shared").over(so_far)).withColumn("hits", F.sum("hits").over(so_far))
    size = F.least("length", F.col("_words") - 1)
    dice = 2.0 * F.col("shared") / (F.col("shared") + size - F.col("hits") + F.col("n_template"))
    scored = steps.withColumn("dice", dice).where(F.col("dice") >= threshold)
    ranked = F.struct((-F.col("dice")).alias("order"), (-size).alias("size"), "licence", "at")
    scored = scored.groupBy("row", "of", family(F.col("licence")).alias("family"), "at").agg(F.min(ranked).alias("best"))
    every = scored.groupBy("row", "of", "family").agg(F.sort_array(F.collect_list("best")).alias("all"))  # at most a row's words
    apart = lambda x, y: (x["at"] >= y["at"] - y["size"]) | (y["at"] >= x["at"] - x["size"])
    none = F.slice("all", 1, 0)
    kept = F.aggregate("all", none, lambda held, x: F.when(F.forall(held, lambda y: apart(x, y)), F.concat(held, F.array(x))).otherwise(held))
    found = every.select("of.*", F.explode(kept).alias("best"))
    return found.select("doc_id", "key", F.lit("window").alias("kind"), "best.at", "best.licence", (-F.col("best.order")).alias("dice"))


def scan(docs: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD, windows: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, best ``licence`` (null if none), its ``dice``, all ``licences`` found, and ``n_units`` that match.

    With ``windows``, licences inside a unit or over several, and whole licence texts, are found too.
    """
    found = matches(docs, text, id, threshold)
    if windows:
        every = found.unionByName(window_matches(docs, text, id, threshold).distinct())
        in_units = F.max(F.when(F.col("kind") != "window", F.col("dice"))).over(W.partitionBy("doc_id", "key", "licence"))
        found = every.withColumn("_units", in_units).where((F.col("kind") != "window") | F.col("_units").isNull() | (F.col("dice") > F.col("_units")))
    hits = found.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.min(F.struct((-F.col("dice")).alias("order"), "licence")).alias("best"),
        F.sort_array(F.collect_set("licence")).alias("licences"),
        F.count_distinct("kind", "at").alias("n_units"),
    )
    rows = docs.select(F.col(id), F.xxhash64(text_of(docs, text)).alias("key"))
    out = rows.join(hits, F.col(id).eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return out.select(
        id,
        F.col("best.licence").alias("licence"),
        (-F.col("best.order")).alias("dice"),
        F.concat_ws(",", "licences").alias("licences"),
        F.coalesce("n_units", F.lit(0)).alias("n_units"),
    )


def _sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ",\n".join(f"({quoted(name)}, {k}, {quoted(text)})" for k, (name, text) in enumerate(TEMPLATES))
    words = r"string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return rf"""
    WITH t AS (SELECT * FROM (VALUES {rows}) v(licence, template, text)),
    tb AS (SELECT licence, template, {pairs} AS b FROM (SELECT licence, template, {words.format("text")} AS w FROM t)),
    tx AS (SELECT licence, template, len(b) AS m, unnest(b) AS bigram FROM tb),
    d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    lines AS (SELECT doc_id, 'line' AS kind, unnest(string_split(body, chr(10))) AS text, unnest(range(len(string_split(body, chr(10))))) AS pos FROM d),
    p AS (SELECT doc_id, body, regexp_split_to_array(body, '\n[ \t\r]*\n') AS ps FROM d),
    paragraphs AS (SELECT doc_id, 'paragraph' AS kind, unnest(ps) AS text, unnest(range(len(ps))) AS pos FROM p),
    u AS (SELECT * FROM lines UNION ALL SELECT * FROM paragraphs WHERE contains(text, chr(10))
          UNION ALL SELECT doc_id, 'text', body, 0 FROM p WHERE len(ps) > 1),
    ub AS (SELECT doc_id, kind, pos, {pairs} AS b FROM (SELECT doc_id, kind, pos, {words.format("text")} AS w FROM u)),
    ux AS (SELECT doc_id, kind, pos, len(b) AS n, unnest(b) AS bigram FROM ub),
    s AS (SELECT doc_id, kind, pos, licence, template, 2.0::DOUBLE * count(*) / (n + m) AS dice
          FROM ux JOIN tx ON ux.bigram = tx.bigram GROUP BY doc_id, kind, pos, licence, template, n, m),
    h AS (SELECT * FROM s WHERE dice >= {THRESHOLD}),
    g AS (SELECT doc_id, first(licence ORDER BY dice DESC, licence) AS licence, max(dice) AS dice,
                 string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(DISTINCT kind || pos) AS n_units FROM h GROUP BY doc_id)
    SELECT documents.doc_id, licence, dice, coalesce(licences, '') AS licences, coalesce(n_units, 0) AS n_units
    FROM documents LEFT JOIN g ON documents.doc_id = g.doc_id
    """


@query(_sql())
def op5_licence_scan(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), windows=True)
