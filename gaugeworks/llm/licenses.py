"""License scans as an exact set-similarity join, in DataFrame functions only.

A text block is a window of BLOCK_WORDS words, half overlapping the next one, so any notice of up to half a
block lies whole in one. A block matches a template when it holds at least the threshold share of the
template's distinct words (containment). The join is exact: words are ordered by how many documents of the
corpus have them, rarest first, and a pair is looked at only if

* the block has enough template words at all (length),
* it shares a word among the first n - o + 1 of the template and b - o + 1 of the block, where o is the
  overlap the threshold asks for (prefix), and
* enough words are left after the place of that word in both (position);

the overlap of such pairs is then counted. Only words of templates can overlap, so blocks are reduced to them.
The templates are a short list given by the caller, which is the only thing that is broadcast.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import slim, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
THRESHOLD = 0.8
BLOCK_WORDS = 64

# Phrases whose places are counted, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


class Template(NamedTuple):
    label: str
    text: str


# The opening words of common public license notices.
TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files to deal in the software without restriction",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
    ),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _tokens(template: Template) -> list[str]:
    return list(dict.fromkeys(template.text.split()))


def needed(n_tokens: int, threshold: float) -> int:
    """Least overlap that reaches the threshold."""
    return max(1, math.ceil(threshold * n_tokens - 1e-9))


def _worded(docs: DataFrame) -> DataFrame:
    """Slim documents with their words, A-Z lowered and no other letter, and a key that tells rows apart by content."""
    return (
        slim(docs)
        .withColumn("text", F.translate("text", UPPER, UPPER.lower()))
        .select(
            "doc_id",
            F.xxhash64("doc_id", "text").alias("row_hash"),
            F.crc32("text").alias("row_crc"),
            F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        )
        .withColumn("n_words", F.size("words").cast("long"))
    )


def _places(phrase: str) -> Column:
    """Starts of a phrase in ``words``, counted from 0; asked only where its rarest-looking words occur."""
    parts = phrase.split()
    same = " AND ".join(f"get(words, i + {k}) = '{p}'" for k, p in enumerate(parts))
    every = " AND ".join(f"array_contains(words, '{p}')" for p in sorted(parts, key=len, reverse=True))
    return F.expr(
        f"CASE WHEN n_words >= {len(parts)} AND {every} "
        f"THEN filter(sequence(0, CAST(n_words AS INT) - {len(parts)}), i -> {same}) "
        f"ELSE CAST(array() AS array<int>) END"
    )


def _index(spark: SparkSession, templates, rank: dict[str, int], threshold: float) -> DataFrame:
    """One row per prefix word of a template: (token, position, need, n_tokens, label, template, tokens)."""
    entries = []
    for number, template in enumerate(templates):
        tokens = sorted(_tokens(template), key=lambda t: rank[t])
        need = needed(len(tokens), threshold)
        for position in range(len(tokens) - need + 1):
            entries.append(
                F.struct(
                    F.lit(tokens[position]).alias("token"),
                    F.lit(position).alias("position"),
                    F.lit(need).alias("need"),
                    F.lit(len(tokens)).alias("n_tokens"),
                    F.lit(template.label).alias("label"),
                    F.lit(number).alias("template"),
                    _array(tokens).alias("tokens"),
                )
            )
    return spark.range(1).select(F.inline(F.array(*entries)))


def matching_blocks(
    worded: DataFrame, frequency: dict[str, int], templates, threshold: float, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(row_hash, row_crc, block, label, containment) of each block and template that reach the threshold."""
    vocabulary = sorted({t for x in templates for t in _tokens(x)}, key=lambda t: (frequency.get(t, 0), t))
    rank = {t: i for i, t in enumerate(vocabulary)}
    index = _index(worded.sparkSession, templates, rank, threshold)
    needs = {x: needed(len(_tokens(x)), threshold) for x in templates}
    least = min(needs.values())
    prefix = sorted({t for x in templates for t in sorted(_tokens(x), key=rank.get)[: len(_tokens(x)) - needs[x] + 1]})
    step = block_words // 2
    blocks = (
        worded.where(F.arrays_overlap("words", _array(prefix)))
        .select(
            "row_hash",
            "row_crc",
            "words",
            F.explode(F.expr(f"sequence(0, greatest(0, (CAST(n_words AS INT) - {step} - 1) div {step}))")).alias("block"),
        )
        # In the order of the vocabulary: array_intersect keeps that of its first argument.
        .withColumn("tokens", F.array_intersect(_array(vocabulary), F.slice("words", F.col("block") * step + 1, block_words)))
        .drop("words")
        .where((F.size("tokens") >= least) & F.arrays_overlap("tokens", _array(prefix)))
    )
    # A block's prefix is longest for the least overlap any template asks for.
    probes = blocks.select(
        "*", F.posexplode(F.expr(f"slice(tokens, 1, size(tokens) - {least} + 1)")).alias("at", "token")
    )
    t = F.broadcast(index.withColumnRenamed("tokens", "template_tokens"))
    left = F.least(F.col("n_tokens") - F.col("position"), F.size("tokens") - F.col("at"))
    overlap = F.size(F.array_intersect("tokens", "template_tokens"))
    return (
        probes.join(t, "token")
        .where((F.size("tokens") >= F.col("need")) & (F.col("at") <= F.size("tokens") - F.col("need")) & (left >= F.col("need")))
        .withColumn("overlap", overlap)
        .where(F.col("overlap") >= F.col("need"))
        .groupBy("row_hash", "row_crc", "block", "template", "label")
        .agg(F.max(F.col("overlap") / F.col("n_tokens")).alias("containment"))
        .drop("template")
    )


def scan_licenses(
    docs: DataFrame, templates=TEMPLATES, phrases=None, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document: n_words, the places of the phrases (n_base, first_word, last_word, base_labels),
    labels with those of matching templates, and score: 1 with a phrase, else the best containment that
    reaches the threshold, else 0.

    Missing texts count as empty ones: no words, no labels, score 0. Repeated rows get one row each; a
    missing doc_id stays missing. Equal containments of several templates give all their labels. Very long texts
    are cut into blocks like others; an empty table gives no rows; further columns, whatever their names, are left
    out.
    """
    phrases = PHRASES if phrases is None else phrases
    worded = _worded(docs)
    vocabulary = sorted({t for x in templates for t in _tokens(x)})
    names = [f"_p{k}" for k in range(len(phrases))]
    based = worded.select("*", *[_places(p).alias(n) for p, n in zip(phrases, names, strict=True)])
    starts = F.concat(*names)
    label = [F.when(F.size(n) > 0, F.lit(x)) for x, n in zip(phrases.values(), names, strict=True)]
    based = stored(
        based.select(
            "doc_id",
            "row_hash",
            "row_crc",
            "n_words",
            F.size(starts).cast("long").alias("n_base"),
            F.array_min(starts).cast("long").alias("first_word"),
            F.array_max(starts).cast("long").alias("last_word"),
            F.array_compact(F.array(*label)).alias("found"),
            F.array_intersect(_array(vocabulary), "words").alias("hits"),
        ),
        "license-words",
    )
    frequency = {r[0]: r[1] for r in based.select(F.explode("hits").alias("t")).groupBy("t").count().collect()}
    matches = (
        matching_blocks(worded, frequency, templates, threshold, block_words)
        .groupBy("row_hash", "row_crc")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    )
    line = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return based.join(matches, ["row_hash", "row_crc"], "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        line(F.col("found")).alias("base_labels"),
        line(F.concat("found", more)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
