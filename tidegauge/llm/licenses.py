"""Licence scans by a positional index of rare words, as column expressions only.

How many documents have a licence word is counted over the whole table. The index holds, for
each template, the places of the rarest words (highest inverse document frequency) of its
mandatory key phrases. Each place of such a word in a document, less the word's place in
the template, is a place where the template may begin. Beginnings on which all of the
template's indexed places agree are kept, and the template is compared word by word there.
A notice has all mandatory words in their places, so none is missed, however frequent its
words are and whatever else the document holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are counted for every document.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices by label; words in [brackets] are mandatory key phrases.
TEMPLATES = {
    "gpl-notice": "This work is licensed under the [GNU General Public License] version 3",
    "gpl-free-software": "This program is [free software] you can redistribute it and or modify it under the terms of the [GNU General Public License] as published by the Free Software Foundation",
    "apache-2.0": "Licensed under the [Apache License Version 2 0]",
    "cc-by-nc": "Licensed under [CC BY NC] 4 0",
    "cc-by-sa": "Licensed under [CC BY SA] 4 0",
    "mit-notice": "Released under the [MIT License]",
    "mit-text": "[Permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files the Software to deal in the Software [without restriction]",
    "bsd-text": "[Redistribution and use in source and binary forms] with or without modification are permitted provided that the following conditions are met",
    "isc-text": "Permission to use copy modify and or distribute this software [for any purpose with or without fee] is hereby granted",
    "mpl-2.0": "This Source Code Form is subject to the terms of the [Mozilla Public License] v 2 0",
    "reserved": "[All rights reserved]",
}
#: Places of a template that are indexed and must agree, share of a template's words that must match.
AGREE, SHARE = 2, 0.8
BEHIND = 1 << 32


def template_words() -> dict[str, list[str]]:
    return {label: text.replace("[", "").replace("]", "").lower().split() for label, text in TEMPLATES.items()}


def key_phrases() -> dict[str, list[tuple[int, list[str]]]]:
    """For each label its mandatory phrases with their place in the template."""
    out = {}
    for label, text in TEMPLATES.items():
        found, at, start = [], 0, 0
        for word in text.lower().split():
            if word.startswith("["):
                start = at
            if word.endswith("]"):
                found.append((start, template_words()[label][start : at + 1]))
            at += 1
        out[label] = found
    return out


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _words_array(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def rare_words(docs: DataFrame, text: str = "text") -> list[str]:
    """The licence words that ``docs`` have, from highest to lowest inverse document frequency over all of them.

    One aggregate with at most a row per licence word and task; the driver sees
    at most a row per licence word.
    """
    vocabulary = sorted({word for words in template_words().values() for word in words})
    found = docs.select(F.array_intersect(_words_array(vocabulary), words_of(F.col(text))).alias("found"))
    rows = found.select(F.explode(F.concat(F.col("found"), F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    counts = {row["word"]: row["count"] for row in rows}
    total = counts.pop("", 0)
    idf = {word: math.log(total / n) for word, n in counts.items()}
    return sorted(idf, key=lambda w: (-idf[w], w))


def indexed(ranked: list[str]) -> dict[str, list[tuple[str, int]]]:
    """For each label the ``AGREE`` rarest words of its key phrases with their places in the template.

    A template with a mandatory word that no document has is left out.
    """
    rank = {word: n for n, word in enumerate(ranked)}
    out = {}
    for label, phrases in key_phrases().items():
        places = [(word, start + k) for start, phrase in phrases for k, word in enumerate(phrase)]
        if all(word in rank for word, _ in places):
            out[label] = sorted(places, key=lambda place: rank[place[0]])[:AGREE]
    return out


def _starts(words: Column, phrase: list[str]) -> Column:
    """Places of the first word of ``phrase``, in an array of words."""
    same = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(phrase)])
    places = F.transform(words, lambda w, i: F.when((w == phrase[0]) & same(i), i))
    return F.when(F.array_contains(words, phrase[0]) & F.array_contains(words, phrase[-1]), F.filter(places, lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>"))


def _candidates(words: Column, rare: Column, index: dict[str, list[tuple[str, int]]]) -> Column:
    """label number * 2 ** 32 + beginning + 2 ** 31, once for each template and beginning on which its indexed places agree."""
    postings = F.array(*[F.struct(F.lit(word).alias("word"), F.lit(n * BEHIND + BEHIND // 2 - at).alias("base")) for n, label in enumerate(TEMPLATES) for word, at in index.get(label, ())])
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: F.array_contains(rare, s["w"]))
    votes = F.flatten(F.transform(hits, lambda h: F.transform(F.filter(postings, lambda p: p["word"] == h["w"]), lambda p: p["base"] + h["i"])))
    ordered = F.array_sort(votes)
    # A beginning that occurs AGREE times stands beside itself in the sorted list.
    again = F.zip_with(ordered, F.slice(ordered, AGREE, F.greatest(F.size(ordered) - AGREE + 1, F.lit(0))), lambda a, b: F.when(a == b, a))
    return F.array_distinct(F.filter(again, lambda x: x.isNotNull()))


def _holds(words: Column, label: str) -> Callable[[Column], Column]:
    """From a candidate of the template ``label`` to a struct (label, score); 0 without its key phrases."""
    template, phrases = template_words()[label], key_phrases()[label]

    def holds(candidate: Column) -> Column:
        start = (candidate % BEHIND - BEHIND // 2).cast("int")
        at = lambda k: F.when(start + k >= 0, F.get(words, F.greatest(start + k, F.lit(0))))
        same = reduce(lambda a, b: a + b, [F.coalesce((at(k) == w).cast("int"), F.lit(0)) for k, w in enumerate(template)])
        keys = reduce(lambda a, b: a & b, [F.coalesce(at(k + j) == w, F.lit(False)) for k, phrase in phrases for j, w in enumerate(phrase)])
        return F.struct(F.lit(label).alias("label"), F.when(keys, same / len(template)).otherwise(0.0).alias("score"))

    return holds


def _verified(words: Column, found: Column) -> Column:
    """Structs (label, score) of the candidates that hold."""
    of = lambda n: F.filter(found, lambda x: F.floor(x / BEHIND) == n)
    checked = [F.transform(of(n), _holds(words, label)) for n, label in enumerate(TEMPLATES)]
    return F.filter(F.concat(*checked), lambda s: s["score"] >= SHARE)


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, rare_words.

    ``rare_words`` are the indexed words that the document has, rarest first.
    ``score`` is the best share of a template's words that stand where they should, 1 where a base phrase was
    found. Null and empty texts have no words, no labels and score 0; repeated rows stay; other columns are
    ignored; an empty table gives no row. No shuffle but the count of licence words.
    """
    ranked = rare_words(docs, text)
    index = indexed(ranked)
    wanted = {word for places in index.values() for word, _ in places}
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), words_of(F.col(text)).alias("words"))
    rows = rows.withColumn("rare", F.array_intersect(_words_array([word for word in ranked if word in wanted]), F.col("words")))
    for n, phrase in enumerate(PHRASES):
        rows = rows.withColumn(f"p{n}", _starts(F.col("words"), phrase.split()))
    empty = F.array().cast("array<bigint>")
    whole = [reduce(lambda a, b: a & b, [F.array_contains("rare", word) for word, _ in places]) for places in index.values()]
    found = F.when(reduce(lambda a, b: a | b, whole), _candidates(F.col("words"), F.col("rare"), index)).otherwise(empty) if index else empty
    rows = rows.withColumn("found", found)
    verdict = F.when(F.size("found") > 0, _verified(F.col("words"), F.col("found")))
    rows = rows.withColumn("verdict", verdict)
    places = F.concat(*[F.col(f"p{n}") for n in range(len(PHRASES))])
    base = F.array_compact(F.array(*[F.when(F.size(f"p{n}") > 0, label) for n, label in enumerate(PHRASES.values())]))
    named = F.coalesce(F.transform("verdict", lambda s: s["label"]), F.array().cast("array<string>"))
    scores = F.coalesce(F.array_max(F.transform("verdict", lambda s: s["score"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, named))), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(scores).alias("score"),
        F.array_join("rare", ",").alias("rare_words"),
    )
