"""License scans: phrase places, and an exact set-similarity join with templates.

A block is a window of a text's words, seen as the set of its words; a template
is a set of words too. Line ends are no borders, so wrapped notices are found.
Windows are twice as long as their stride, and a template meets those whose
stride is the least power of two that holds all its words: any place of that
many words lies in a whole window. A template fits a block if enough of its
words (``threshold``; all, of short ones) are there, among them those that tell
its license from others. The join is exact: template words are ordered by how
many texts of the whole corpus hold them, rarest first; a fitting block must
share one of the first ``|T| - need + 1`` words (prefix filter), hold ``need``
template words at all (length filter), and leave enough words after the first
common one on both sides (positional filter). What passes is verified.

Texts are read and normalised once; of each the phrase places are kept, the
template words that it holds, and their places if the whole text holds enough
words of some template (a block can't hold more). All of it is DataFrame
expressions; the template table has a fixed size and is broadcast, as are the
counts of its words.

Defined results: a null or empty text has no words, no labels and score 0; a
text of any length is judged whole; repeated rows are judged alike and all
kept; templates of equal containment all give their labels; an empty table
gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, materialise

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, words of a common notice, and words that it can't do without.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ""),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org", "apache"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "redistributions"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution international"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ""),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "gnu 3"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", "gnu 2"),
    ("mit", "Released under the MIT License", ""),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "granted charge"),
    ("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "sublicense"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "fee granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "mozilla mpl"),
]
THRESHOLD = 0.8
#: Templates of fewer distinct words must be there whole.
SHORT = 10
_LOWER = str.maketrans(UPPER, LOWER)
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(_LOWER))


def normal(text: Column) -> Column:
    """Words of a text joined by single spaces."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), _GAP, " "))


def template_rows(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple[int, str, list[str], int, list[str], int]]:
    """(template, label, distinct words, words needed, words that must be there, stride of its blocks)."""
    rows = []
    for i, (label, text, must) in enumerate(templates):
        every = words_of(text)
        w = sorted(set(every))
        rows.append((i, label, w, len(w) if len(w) < SHORT else math.ceil(threshold * len(w) - 1e-9), words_of(must), 1 << max(0, len(every) - 1).bit_length()))
    return rows


def prepare(docs: DataFrame, rows: list[tuple], id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES) -> DataFrame:
    """id, key of the text, n_words, n_base, first_word, last_word, the array of base labels; ``found``, the template words that the text holds,
    and ``places`` of them (empty unless the text holds enough words of a template). Materialised."""
    d = docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_key"), normal(F.col(text_col)).alias("norm"))
    padded = F.concat(F.lit(" "), F.col("norm"), F.lit(" "))
    count = {p: F.when(F.contains(padded, F.lit(f" {p} ")), F.regexp_count(padded, F.lit(f" {p}(?= )"))).otherwise(0) for p in phrases}
    either = "|".join(phrases)
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    before = lambda star: spaces(F.regexp_extract(padded, f"(?s)^({star}) (?:{either})(?= )", 1)).cast("long")
    vocabulary = sorted({w for r in rows for w in r[2]})
    d = d.withColumns({"n_base": sum(count.values()).cast("long"), "words": F.split("norm", " ")})
    d = d.withColumn("found", F.array_intersect("words", F.lit(vocabulary)))
    enough = [F.size(F.array_intersect("found", F.lit(words))) >= need for _, _, words, need, _, _ in rows]
    places = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda p: p["word"].isin(vocabulary))
    labels = F.array_compact(F.array(*[F.when(F.contains(padded, F.lit(f" {p} ")), label) for p, label in phrases.items()]))
    return materialise(d.select(
        id_col,
        "text_key",
        F.when(F.col("norm") == "", 0).otherwise(spaces(F.col("norm")) + 1).cast("long").alias("n_words"),
        "n_base",
        F.when(F.col("n_base") > 0, before(".*?")).alias("first_word"),
        F.when(F.col("n_base") > 0, before(".*")).alias("last_word"),
        labels.alias("base_labels"),
        "found",
        F.when((F.size("found") >= min(r[3] for r in rows)) & reduce(or_, enough), places).alias("places"),
    ))


def blocks(prepared: DataFrame, strides: list[int], id_col: str = "doc_id") -> DataFrame:
    """A row per window that holds a template word: id, text_key, stride, block, words (of templates)."""
    spots = prepared.select(id_col, "text_key", F.explode("places").alias("p")).select(id_col, "text_key", F.col("p.at").alias("at"), F.col("p.word").alias("word"))
    strided = spots.withColumn("stride", F.explode(F.lit(strides)))
    last = F.floor(F.col("at") / F.col("stride"))
    held = strided.withColumn("block", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)))
    return held.groupBy(id_col, "text_key", "stride", "block").agg(F.collect_set("word").alias("words"))


def word_counts(prepared: DataFrame) -> dict[str, int]:
    """Texts with each template word, over the whole corpus; at most one entry for each such word."""
    return {r["w"]: r["n"] for r in prepared.select(F.explode("found").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}


def join_templates(prepared: DataFrame, rows: list[tuple], id_col: str = "doc_id") -> DataFrame:
    """Every fitting (block, template): id, text_key, stride, block, template, label, containment."""
    counts = word_counts(prepared)
    order = sorted({w for r in rows for w in r[2]}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefix = []
    for t, label, words, need, must, stride in rows:
        ordered = sorted(words, key=rank.__getitem__)
        prefix += [(w, stride, t, label, i, len(words), need, ordered, must) for i, w in enumerate(ordered[: len(words) - need + 1])]
    table = prepared.sparkSession.createDataFrame(prefix, "word string, t_stride int, template int, label string, t_pos int, t_size int, need int, t_words array<string>, must array<string>")
    found = blocks(prepared, sorted({r[5] for r in rows}), id_col)
    ordered = found.filter(F.size("words") >= min(r[3] for r in rows)).withColumn("words", F.array_intersect(F.lit(order), "words"))
    probes = ordered.select("*", F.posexplode("words").alias("b_pos", "word"))
    hits = probes.join(F.broadcast(table), (probes["word"] == table["word"]) & (F.col("stride") == F.col("t_stride"))).filter(F.size("words") >= F.col("need"))  # prefix and length
    earlier = F.arrays_overlap(F.slice("t_words", F.lit(1), F.col("t_pos")), F.slice("words", F.lit(1), F.col("b_pos")))
    hits = hits.filter((F.col("t_pos") == 0) | (F.col("b_pos") == 0) | ~earlier)  # the first common word alone
    left = F.least(F.col("t_size") - F.col("t_pos"), F.size("words") - F.col("b_pos"))
    hits = hits.filter(left >= F.col("need"))  # position
    overlap = F.size(F.array_intersect("words", "t_words"))
    fits = (overlap >= F.col("need")) & (F.size(F.array_except("must", "words")) == 0)
    return hits.filter(fits).select(id_col, "text_key", "stride", "block", "template", "label", (overlap / F.col("t_size")).alias("containment"))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base places and labels of each row, with the labels and best containment of its fitting templates."""
    rows = template_rows(templates, threshold)
    d = prepare(docs, rows, id_col, text_col)
    fits = join_templates(d, rows, id_col)
    by_text = fits.groupBy(F.col(id_col).alias("fit_id"), F.col("text_key").alias("fit_key")).agg(F.collect_set("label").alias("fit_labels"), F.max("containment").alias("best"))
    d = d.drop("found", "places").join(by_text, F.col(id_col).eqNullSafe(F.col("fit_id")) & (F.col("text_key") == F.col("fit_key")), "left")
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return d.select(
        id_col, "n_words", "n_base", "first_word", "last_word",
        text(F.col("base_labels")).alias("base_labels"),
        text(F.concat("base_labels", F.coalesce("fit_labels", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def query(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_NORM = r"trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'))"


def _oracle() -> str:
    rows = template_rows()
    templates = ", ".join(f"('{label}', {words!r}, {need}, {must!r}::VARCHAR[], {stride})" for _, label, words, need, must, stride in rows)
    phrases = ", ".join(f"('{label}', {p.split()!r})" for p, label in PHRASES.items())
    strides = ", ".join(map(str, sorted({r[5] for r in rows})))
    return f"""
WITH t AS (SELECT * FROM (VALUES {templates}) AS x(label, words, need, must, stride)),
p AS (SELECT * FROM (VALUES {phrases}) AS x(label, words)),
d AS (SELECT doc_id, {_NORM.format("coalesce(text, '')")} AS norm FROM documents),
w AS (SELECT doc_id, CASE WHEN norm = '' THEN []::VARCHAR[] ELSE string_split(norm, ' ') END AS words FROM d),
spot AS (SELECT doc_id, words, unnest(range(len(words))) AS i FROM w),
place AS (SELECT doc_id, p.label, i FROM spot JOIN p ON list_slice(spot.words, i + 1, i + len(p.words)) = p.words),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS l FROM place GROUP BY doc_id),
k AS (SELECT doc_id, words, stride, unnest(range((len(words) + stride - 1) // stride)) AS i FROM w, (SELECT unnest([{strides}]) AS stride)),
block AS (SELECT doc_id, stride, list_distinct(list_slice(words, i * stride + 1, (i + 2) * stride)) AS words FROM k),
fit AS (SELECT doc_id, list(DISTINCT label) AS l, max(len(list_intersect(block.words, t.words)) / len(t.words)) AS best
  FROM block JOIN t ON block.stride = t.stride AND len(list_intersect(block.words, t.words)) >= t.need AND list_has_all(block.words, t.must) GROUP BY doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.l), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.l, []), coalesce(fit.l, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN fit USING (doc_id)
"""


ORACLE = _oracle()
