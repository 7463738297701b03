"""License scans: set-similarity join of text blocks with license templates.

A block is a run of words as long as twice the longest template, taken every half of that, so a template's
text lies whole in some block. A template meets a block if at least ``CONTAINMENT`` of its distinct words are
there. Template words are ordered by how many documents of the corpus have them, rare ones first, and a block
is the set of its template words in that order; others can match nothing. A block that meets a template shares
one of the template's rarest words with it, by which they are joined (prefix), has enough words (length), and
both have enough words left from that word on (position). The pairs that pass are counted exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import ascii_lower, by_name, by_place, landed

CONTAINMENT = 0.8

# Phrases that count wherever they stand, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public license notices, as sets of words.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
    ),
    "apache": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ),
    "cc": "licensed under cc by 4 0",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of the lower-cased text; a null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAP), "")


def _phrase_starts(words: Column, phrase: str) -> Column:
    parts = phrase.split()

    def here(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.coalesce(F.get(words, i + k) == p, F.lit(False)) for k, p in enumerate(parts)])

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _literal(words) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``docs`` with ``n_words``, ``starts`` (of phrases), ``base_labels``, ``labels`` and ``score``.

    ``starts`` are word numbers from 0, ``labels`` those of phrases and of templates that a block meets, sorted,
    and ``score`` the largest share of a template's words found in one block, among templates met, 1 for a phrase,
    else 0. A null or empty text has no words and no labels. Rows are scanned one by one, repeated ones too, and a
    null key does no harm. Other columns pass through, whatever their names; those named like a new column are
    replaced. An empty table gives an empty one. ``templates`` are arguments of the program; every word of theirs
    becomes part of the expression.
    """
    placed, places = by_place(docs, *([key, text] if key in docs.columns else [text]))
    scanned = _scanned(placed, places[0] if len(places) > 1 else None, places[-1], containment, templates)
    return by_name(scanned, docs.columns, "n_words", "starts", "base_labels", "labels", "score")


def _scanned(docs: DataFrame, key: str | None, text: str, containment: float, templates: dict[str, str] | None) -> DataFrame:
    sets = {n: sorted(set(t.split())) for n, t in (TEMPLATES if templates is None else templates).items()}
    vocabulary = sorted({w for s in sets.values() for w in s})
    kept = docs.columns

    # Corpus counts of template words, over all documents; at most one row per word of the templates.
    common = F.array_intersect(words_of(F.col(text)), _literal(vocabulary))
    counted = docs.select(F.explode(common).alias("w")).groupBy("w").count().collect()
    share = {r["w"]: r["count"] for r in counted}
    order = sorted(vocabulary, key=lambda w: (share.get(w, 0), w))
    ranked = {n: sorted(s, key=order.index) for n, s in sets.items()}
    need = {n: max(1, -int(-containment * len(s) // 1)) for n, s in ranked.items()}
    longest = max(len((TEMPLATES if templates is None else templates)[n].split()) for n in sets)
    prefixes = sorted({w for n, s in ranked.items() for w in s[: len(s) - need[n] + 1]})

    words = docs.select(*[F.col(f"`{c}`") for c in kept], words_of(F.col(text)).alias("_w"))
    names = {p: i for i, p in enumerate(PHRASES)}
    last_words = F.array_intersect("_w", _literal(sorted({p.split()[0] for p in PHRASES} | {p.split()[-1] for p in PHRASES})))
    may_phrase = F.array_contains(last_words, "license")
    none = F.array().cast("array<int>")
    found = {p: F.when(may_phrase, _phrase_starts(F.col("_w"), p)).otherwise(none).alias(f"_s{i}") for p, i in names.items()}
    # A document that lacks a template's words as a whole has no block with them.
    seen = F.array_intersect("_w", _literal(vocabulary)).alias("_seen")
    base = words.select("*", *found.values(), seen)
    may_block = reduce(lambda a, b: a | b, [F.size(F.array_intersect("_seen", _literal(s))) >= need[n] for n, s in ranked.items()])
    span, step = 2 * longest, longest
    begins = F.sequence(F.lit(0), F.greatest(F.size("_w") - F.lit(span) + F.lit(step) - 1, F.lit(0)), F.lit(step))
    blocks = F.transform(begins, lambda i: F.slice(F.col("_w"), i + 1, F.lit(span)))
    blocks = F.transform(blocks, lambda b: F.array_intersect(_literal(order), b))  # in the order of the first one
    blocks = F.filter(blocks, lambda b: (F.size(b) >= min(need.values())) & F.arrays_overlap(b, _literal(prefixes)))
    starts = F.array_sort(F.concat(*[F.col(f"_s{i}") for i in names.values()]))
    labels = F.array_compact(F.array(*[F.when(F.size(f"_s{i}") > 0, F.lit(PHRASES[p])) for p, i in names.items()]))
    own = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.coalesce(F.col(text), F.lit("")))) if key else F.md5(F.coalesce(F.col(text), F.lit("")))
    base = base.select(
        *[F.col(f"`{c}`") for c in kept],
        F.size("_w").cast("long").alias("n_words"),
        starts.alias("starts"),
        F.array_sort(F.array_distinct(labels)).alias("base_labels"),
        own.alias("_own"),
        F.when(may_block, blocks).otherwise(F.array().cast("array<array<string>>")).alias("_blocks"),
    )
    filled = base.where(F.size("_blocks") > 0).select("_own", F.explode("_blocks").alias("_block")).distinct()
    met = landed(_met(_candidates(filled, ranked, need)), "license-blocks")
    joined = base.drop("_blocks").join(met, "_own", "left")
    every = F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("_met", F.array().cast("array<string>")))))
    score = F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0)))
    return joined.select(*[F.col(f"`{c}`") for c in kept], "n_words", "starts", "base_labels", every.alias("labels"), score.alias("score"))


def _candidates(blocks: DataFrame, ranked: dict[str, list[str]], need: dict[str, int]) -> DataFrame:
    """Blocks with the templates that they may meet; words of both are in the common order."""
    prefixes = [(n, w, i, need[n], s) for n, s in ranked.items() for i, w in enumerate(s[: len(s) - need[n] + 1])]
    # A row per prefix word of the templates, which are arguments of the program: small enough to broadcast.
    index = blocks.sparkSession.createDataFrame(prefixes, "template string, w string, at int, need int, words array<string>")
    each = blocks.select("_own", "_block", F.posexplode("_block").alias("pos", "w"))
    hits = each.join(F.broadcast(index), "w").where(F.size("_block") >= F.col("need"))
    # Of the first word that both have, this is the most that they can share; a later word is no loss.
    most = F.least(F.size("words") - F.col("at"), F.size("_block") - F.col("pos"))
    return hits.where(most >= F.col("need")).select("_own", "_block", "template", "need", "words").distinct()


def _met(candidates: DataFrame) -> DataFrame:
    """Templates that some block of a document meets: document, labels, best share."""
    shared = F.size(F.array_intersect("_block", "words"))
    whole = candidates.select("_own", "template", "need", shared.alias("n"), F.size("words").alias("size")).where("n >= need")
    return whole.groupBy("_own").agg(F.collect_set("template").alias("_met"), F.max(F.col("n") / F.col("size")).alias("_score"))
