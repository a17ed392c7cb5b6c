"""Texts whose sets of word shingles are similar, as links that connect them.

A text's shingles are hashed, and ``BANDS`` keys of ``BAND_ROWS`` minima each are taken from the
hashes. Two texts with a similarity of 0.8 share a key in all but one case of 1,500; more
similar ones practically always. In each bucket every text is compared with the
bucket's first one, which settles groups of copies without listing their pairs. A bucket
whose texts are not all connected by that is searched whole: those that share one of the
smallest hashes of their sets, which similar sets must, are compared if not connected
yet. Every comparison is exact, over both sets of hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, settle
from .components import components

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
BANDS, BAND_ROWS, AT_ONCE = 40, 8, 4096
#: Texts and hashes (8 bytes each) of a part of a bucket.
PART, PART_HASHES = 1024, 2_000_000


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of the whole sequence if there are fewer words; none without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(x) + 1 for x in words]) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    of = xxhash.xxh64_intdigest
    return np.unique(np.array([of(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())], dtype=np.uint64))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2**63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


ODD, MIX = _multipliers()


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` keys, each from ``BAND_ROWS`` minima of the hashes under different multipliers."""
    least = np.full(len(ODD), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), AT_ONCE):
        mixed = hashes[at : at + AT_ONCE, None] * ODD
        np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0), out=least)
    keys = (least.reshape(BANDS, BAND_ROWS) * MIX).sum(axis=1, dtype=np.uint64)
    return (keys ^ (keys >> np.uint64(31))) * ODD[:BANDS]


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the sets' intersection is at least ``least`` of their union. Both are sorted."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or len(small) < least * len(large):
        return False
    places = np.searchsorted(large, small)
    both = int((large[np.minimum(places, len(large) - 1)] == small).sum())
    return both >= least * (len(a) + len(b) - both)


def sketched(shingle: int = SHINGLE):
    """Column function from a text to its bands. A text without words has none."""

    @F.arrow_udf("array<bigint>")
    def sketch(texts: pa.Array) -> pa.Array:
        sets = (shingle_hashes(text.as_py(), shingle) for text in texts)
        return pa.array([band_keys(hashes).view(np.int64) if len(hashes) else [] for hashes in sets], pa.list_(pa.int64()))

    return sketch


def _hashed(shingle: int):
    """Column function from a text to its sorted hashes, as signed numbers."""

    @F.arrow_udf("array<bigint>")
    def hashed(texts: pa.Array) -> pa.Array:
        sets = [shingle_hashes(text.as_py(), shingle).view(np.int64) for text in texts]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))

    return hashed


def prefix(hashes: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """The smallest hashes, so many that similar sets must share one of them.

    Sets with a similarity of ``least`` have at least ``least`` of either's hashes in common. The smallest of these is
    followed by all others, so it is among the first ``n - ceil(least * n) + 1`` of both.
    """
    return hashes[: len(hashes) - math.ceil(least * len(hashes) - 1e-9) + 1]


def connected(sets: list[np.ndarray], known: np.ndarray, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of places that connect, together with equal ``known``, all places with similar sets. Sets are sorted.

    Places are looked up by the hashes of their prefixes; of those that share one, only such with a
    fitting size and not yet connected are compared. No similar pair is left out.
    """
    group, found = np.unique(known, return_inverse=True)[1], []
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    prefixes = [prefix(x, least) for x in sets]
    firsts = np.concatenate([np.empty(0, np.uint64), *prefixes])
    owners = np.repeat(np.arange(len(sets)), [len(x) for x in prefixes])
    order = np.argsort(firsts, kind="stable")
    firsts, owners = firsts[order], owners[order]
    for a in range(len(sets)):
        low, high = np.searchsorted(firsts, prefixes[a], "left"), np.searchsorted(firsts, prefixes[a], "right")
        shared = [owners[i:j] for i, j in zip(low.tolist(), high.tolist()) if j - i > 1]
        others = np.unique(np.concatenate([owners[:0], *shared]))
        others = others[(others < a) & (np.minimum(sizes[others], sizes[a]) >= least * np.maximum(sizes[others], sizes[a]))]
        for b in others[group[others] != group[a]].tolist():
            if group[a] != group[b] and similar(sets[a], sets[b], least):
                found.append((a, b))
                group[group == group[b]] = group[a]
    return found


def _searched(least: float):
    """Rows (unit, number, root, hashes), sorted by unit, to links (a, b) of numbers."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        seen = list({row[0]: row for row in rows}.values())
        pairs = connected([row[2] for row in seen], np.array([row[1] for row in seen], dtype=np.int64), least)
        ends = [pa.array([seen[pair[side]][0] for pair in pairs], pa.int64()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for batch in batches:
            units, numbers, roots = (batch.column(i).to_pylist() for i in range(3))
            hashes = batch.column(3)
            values, ends = hashes.values.to_numpy().view(np.uint64), hashes.offsets.to_numpy()
            for i, key in enumerate(units):
                if key != unit and rows:
                    yield links(rows)
                    rows = []
                unit = key
                # A copy, so that the batch can go.
                rows.append((numbers[i], roots[i], np.sort(values[ends[i] : ends[i + 1]])))
        if rows:
            yield links(rows)

    return run


def similar_links(rows: DataFrame, least: float = SIMILARITY, shingle: int = SHINGLE, part: int = PART, part_hashes: int = PART_HASHES) -> DataFrame:
    """Links (a, b) of numbers that connect only rows with a chain of steps of similarity ``least`` or more.

    Steps are missed only between texts that share no band.

    ``rows``: a written table with number, text, and bands as :func:`sketched` gives them. A text without words
    has no band and no link; very long texts are sets like others; an empty table gives no link.
    Sets are made of the texts that share a bucket with another one, and only they
    are moved. Buckets of more than ``part`` rows or ``part_hashes`` hashes are cut, and each pair of parts is searched.
    """
    keyed = rows.select("number", F.posexplode("bands").alias("place", "key")).select("number", F.xxhash64("place", "key").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("number").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = settle(keyed.join(buckets, "band").select("band", "number", "hub"), "similar-buckets")
    # Written tables tell their size, by which Spark chooses to broadcast or to shuffle.
    busy = settle(shared.select("number").distinct(), "similar-numbers")
    known = rows.select("number", "text").join(busy, "number", "left_semi")
    sets = settle(known.select("number", _hashed(shingle)("text").alias("hashes")), "similar-sets")
    stars = shared.filter("number != hub").select("number", "hub").distinct().join(sets, "number")
    tested = stars.join(sets.select(F.col("number").alias("hub"), F.col("hashes").alias("others")), "hub")
    # In the JVM, row by row: batches for Python would hold 10,000 pairs of sets.
    both, all_ = F.size(F.array_intersect("hashes", "others")), F.size("hashes") + F.size("others")
    tested = tested.filter(F.least(F.size("hashes"), F.size("others")) >= F.lit(least) * F.greatest(F.size("hashes"), F.size("others")))
    first = settle(tested.filter(both >= F.lit(least) * (all_ - both)).select(F.col("number").alias("a"), F.col("hub").alias("b")), "similar-stars")
    roots = components(first)
    rooted = shared.join(roots.withColumnRenamed("node", "number"), "number", "left").select("band", "number", F.coalesce("root", "number").alias("root"))
    rooted = settle(rooted.join(sets.select("number", F.size("hashes").alias("hashed")), "number"), "similar-roots")
    cut = F.ceil(F.greatest(F.count(F.lit(1)) / part, F.sum("hashed") / part_hashes)).alias("parts")
    mixed = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), cut).filter("low != high").select("band", "parts")
    own = F.pmod(F.xxhash64("number"), F.col("parts"))
    crowd = rooted.join(mixed, "band").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    units = crowd.select(F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "number", "root")
    units = units.join(sets, "number").select("unit", "number", "root", "hashes")
    found = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_searched(least), "a long, b long").distinct()
    return first.unionByName(settle(found, "similar-found"))
