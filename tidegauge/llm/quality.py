"""Quality by hashed n-grams: a log-likelihood ratio between trusted and raw text, beside fixed rules.

Words and pairs of neighbouring words are hashed into ``BUCKETS``. One pass over all documents
counts the buckets of the raw corpus, one over trusted rows those of trusted text; a last
one scores each document by the mean of log(p_trusted / p_raw) over its n-grams. Trusted rows are halved by hash: one half is
counted, the threshold is read off the scores of the other, of which all but ``TRUSTED_LOSS``
are above it. Every document is then decided alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, workers_know

BUCKETS = 1 << 18
#: Share of the trusted rows that may fall below the threshold, and the width in which scores are counted.
TRUSTED_LOSS, STEP = 0.002, 0.01
#: Added to each bucket: 2^15 grams in all, however many buckets.
SMOOTHING = (1 << 15) / BUCKETS
#: Bits a trusted id has in the filter that tells which texts may be trusted; bits of all at most (32 MB), and of a row, as many as Spark's bitmaps have.
ID_BITS, FILTER_BITS, ROW_BITS = 128, 1 << 28, 1 << 15
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
SYMBOLS = "#*$%&|<>"
RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,grams:bigint,score:double>"


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more. ``codes`` are equal just for equal words.

    Windows are named step by step, so that windows are equal just when their names are.
    """
    count = len(codes) - window + 1
    if count < 2:
        return 0
    names = codes[:count].astype(np.int64)
    size = int(codes.max()) + 1
    for k in range(1, window):
        names, found = pd.factorize(names * size + codes[k : k + count])
        if len(found) == count:
            return 0
    twice = np.bincount(names)[names] > 1
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(change, np.flatnonzero(twice), 1)
    np.add.at(change, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, out = set(), 0
    for line in text.split("\n"):
        if line in seen:
            out += 1
        elif SPACED.search(line):
            seen.add(line)
    return out


class Words:
    """The words of a batch of texts as codes, with a hash for each distinct word."""

    def __init__(self, texts: list[str]):
        self.lists = [SPACED.findall(text) for text in texts]
        codes: dict[str, int] = {}
        self.codes = [np.array([codes.setdefault(word, len(codes)) for word in words], dtype=np.int64) for words in self.lists]
        self.hashes = np.array([zlib.crc32(word.lower().encode()) for word in codes], dtype=np.uint64)
        self.sizes = np.array([len(word) for word in codes], dtype=np.int64)

    def buckets(self, i: int) -> np.ndarray:
        """Buckets of the words and pairs of text ``i``."""
        one = self.hashes[self.codes[i]]
        mixed = np.concatenate([one, one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] + np.uint64(1)]) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _counted():
    """Rows (bucket, found) of a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                words = Words([x or "" for x in batch.column(0).slice(at, 500).to_pylist()])
                for i, codes in enumerate(words.codes):
                    if len(codes) * 4 > BUCKETS:
                        sums += np.bincount(words.buckets(i), minlength=BUCKETS)
                    else:
                        np.add.at(sums, words.buckets(i), 1)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "found"])

    return run


def trusted_ids(labels: DataFrame, doc_id: str, label: str, half: int) -> DataFrame:
    """Ids (``id``) of a half of the rows with label 1, chosen by hash. Half 0 is for counts, 1 for the threshold."""
    known = labels.filter(F.col(label) == 1).select(F.col(doc_id).cast("long").alias("id")).filter("id IS NOT NULL").distinct()
    return known.filter(F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) == half)


def _slot(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(FILTER_BITS))


def _filter_bits(ids: int) -> int:
    """A power of two, ``ID_BITS`` or more for each of so many ids, up to ``FILTER_BITS``."""
    return min(FILTER_BITS, max(ROW_BITS, 1 << (ID_BITS * ids - 1).bit_length()))


def _may_be_in(ids: DataFrame):
    """Column function from a slot to whether one of ``ids`` may have it.

    The filter grows with the ids, so that fewer than one other id in a hundred passes. From two million ids
    on it stays as large as it is and passes more.
    """
    size = _filter_bits(ids.count())
    slots = ids.select((_slot(F.col("id")) % size).alias("slot"))
    rows = slots.groupBy(F.floor(F.col("slot") / ROW_BITS).alias("row")).agg(F.bitmap_construct_agg(F.col("slot") % ROW_BITS).alias("bits"))
    filled = np.zeros((size // ROW_BITS, ROW_BITS // 8), dtype=np.uint8)
    for row in rows.collect():
        filled[row["row"]] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    known = ids.sparkSession.sparkContext.broadcast(filled.ravel())

    @F.arrow_udf("boolean")
    def may_be_in(slots: pa.Array) -> pa.Array:
        at = slots.to_numpy(zero_copy_only=False) % size
        return pa.array((known.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    return may_be_in


def log_ratios(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """log(p_trusted / p_raw) of every bucket. Raw counts are those of all documents, trusted ones those of half 0."""
    rows = workers_know(docs).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    counts = np.full((2, BUCKETS), SMOOTHING)
    ids = trusted_ids(labels, doc_id, label, 0)
    # The filter only spares the shuffle of other texts; the join decides.
    trusted = rows.filter(_may_be_in(ids)(_slot(F.col("id")))).join(ids, "id", "left_semi")
    for side, some in enumerate((trusted, rows)):
        sums = some.select("text").mapInArrow(_counted(), "bucket long, found long").groupBy("bucket").agg(F.sum("found").alias("found"))
        found = sums.toArrow()  # at most BUCKETS rows
        counts[side, found["bucket"].to_numpy()] += found["found"].to_numpy()
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def _judged(ratios):
    @F.arrow_udf(OUT)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ratios.value
        for batch in batches:
            out = []
            for at in range(0, len(batch), 500):
                texts = [x or "" for x in batch.slice(at, 500).to_pylist()]
                words = Words(texts)
                for i, text in enumerate(texts):
                    codes = words.codes[i]
                    used = words.buckets(i)
                    symbols = sum(map(text.count, SYMBOLS))
                    local = pd.factorize(codes)[0]
                    score = float(table[used].mean()) if len(used) else 0.0
                    out.append((len(codes), int(words.sizes[codes].sum()), symbols, duplicate_lines(text), repeated_words(local), len(used), score))
            columns = [pa.array(c, k) for c, k in zip([*zip(*out)] or [[]] * 7, [pa.int64()] * 6 + [pa.float64()])]
            yield pa.StructArray.from_arrays(columns, [*RULES, "grams", "score"])

    return judged


def threshold(judged: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> float:
    """The highest step below which at most ``TRUSTED_LOSS`` of all trusted rows of half 1 score; -inf without any.

    ``judged`` has ``doc_id`` and ``score``. Scores are counted in steps, so the result does
    not depend on how rows are dealt out.
    """
    ids = trusted_ids(labels, doc_id, label, 1).withColumnRenamed("id", "_id")
    found = judged.join(ids, F.col("doc_id") == F.col("_id")).filter("grams > 0")
    steps = sorted((row["step"], row["count"]) for row in found.groupBy(F.floor(F.col("score") / STEP).alias("step")).count().collect())
    room, out = TRUSTED_LOSS * sum(n for _, n in steps), -np.inf
    for step, n in steps:
        out = step * STEP
        room -= n
        if room < 0:
            break
    return float(out)


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of ``docs``: doc_id, the five counts, base_failed, kept, score.

    Null and empty texts have no words, score 0 and fail the rules; repeated rows stay; without
    trusted rows the rules alone decide; other columns are ignored; an empty table gives no row.
    Texts are read three times. Those that may be counted as trusted are shuffled once, unless
    the trusted ids are few enough to be broadcast.
    """
    from .common import settle

    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, labels, doc_id, text, label))
    rows = workers_know(docs).select(F.col(doc_id).cast("long").alias("doc_id"), _judged(ratios)(F.col(text)).alias("j")).select("doc_id", "j.*")
    rows = settle(rows, "quality")
    least = threshold(rows, labels, doc_id, label)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select("doc_id", *RULES, failed.alias("base_failed"), (~failed & (F.col("score") >= F.lit(least))).alias("kept"), "score")
