"""SimHash near duplicates: fingerprints of 64 bits, linked by BK-trees.

Distinct fingerprints are cut into ``radius + 2`` blocks of bits. Two that differ in at
most ``radius`` bits agree in two blocks at least, so each pair of blocks with its
value names a shard, and no link is lost between shards. A BK-tree is built per shard
(children keyed by their Hamming distance to the parent) and only edges within the
radius of a query's distance are followed. A tree goes to the task of its own queries
rather than to all executors, because trees of all shards grow with the corpus.
A crowded shard is cut into parts of at most ``PART`` fingerprints; every pair of
parts is one task's tree and queries. Links are never listed pair by pair: a tree
gives each fingerprint the smallest one it is connected with there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .bktree import BKTree
from .common import LOWER, settle, whole_row, workers_know
from .components import components

SHINGLE, SEED, BITS, RADIUS, PART = 3, 42, 64, 3, 4096
HASHED_AT_ONCE = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's shingles."""
    words = (text or "").encode().translate(LOWER).split()  # bytes split at ASCII white space, as asked
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(x) + 1 for x in words]) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    stops, of = ends[width - 1 :].tolist(), xxhash.xxh64_intdigest
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), HASHED_AT_ONCE):
        some = zip(starts[at : at + HASHED_AT_ONCE], stops[at : at + HASHED_AT_ONCE])
        hashes = np.array([of(joined[a:b], SEED) for a, b in some], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(starts)).tobytes(), "big")


def _fingerprinted():
    @F.arrow_udf("long")
    def fingerprinted(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(x.as_py()) for x in texts], dtype=np.uint64).view(np.int64))

    return fingerprinted


def smallest_linked(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of the distinct ``prints``, sorted, the place of the smallest it is connected with."""
    parent = np.arange(len(prints))

    def roots(places: np.ndarray) -> np.ndarray:
        found = parent[places]
        while (further := parent[found]).tolist() != found.tolist():
            found = further
        return found

    for node, hits in BKTree(prints).near(prints, radius):
        if len(hits) > 1:
            found = roots(np.append(hits, node))
            parent[found] = found.min()
    return roots(parent)


def _linked(radius: int):
    """Rows (unit, print) sorted by unit to links (print, smallest connected print) in that unit."""

    def links(unit: np.ndarray) -> np.ndarray:
        prints = np.unique(unit.view(np.uint64))
        if len(prints) == 2:  # most shards
            root = np.zeros(2, dtype=np.int64) if np.bitwise_count(prints[0] ^ prints[1]) <= radius else np.arange(2)
        else:
            root = smallest_linked(prints, radius)
        moved = root != np.arange(len(prints))
        return np.stack([prints[moved].view(np.int64), prints[root[moved]].view(np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_units, held_prints = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        table, last = None, False
        source = iter(batches)
        while not last:
            batch = next(source, None)
            last = batch is None
            if not last:
                held_units = np.concatenate([held_units, batch.column(0).to_numpy()])
                held_prints = np.concatenate([held_prints, batch.column(1).to_numpy()])
            edges = np.flatnonzero(np.diff(held_units)) + 1
            bounds = [0, *edges.tolist(), *([len(held_units)] if last else [])]
            found = [links(held_prints[a:b]) for a, b in zip(bounds, bounds[1:]) if b > a]
            held_units, held_prints = held_units[bounds[-1] :], held_prints[bounds[-1] :]
            if found:
                table = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(table[0]), pa.array(table[1])], names=["a", "b"])

    return run


def links(prints: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Links (a, b) that connect just the fingerprints with a chain of steps of at most ``radius`` bits.

    ``prints``: one long column ``print`` of distinct fingerprints.
    """
    count = radius + 2
    edges = [BITS * i // count for i in range(count + 1)]
    blocks = [F.shiftrightunsigned(F.col("print"), edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)) for i in range(count)]
    shards = [F.xxhash64(F.lit(i * count + j), blocks[i], blocks[j]) for i, j in combinations(range(count), 2)]
    keyed = prints.select("print", F.explode(F.array(*shards)).alias("shard"))
    crowds = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / part)
    own = F.pmod(F.xxhash64("print"), parts)
    busy = keyed.join(crowds, "shard").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    units = busy.select(F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "print")
    # Units whose hashes collide share a tree, which finds true links only.
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_linked(radius), "a long, b long").distinct()


def _prints(rows: DataFrame) -> DataFrame:
    return rows.groupBy("print").agg(F.min("id").alias("least"))


def _roots(prints: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(print, root) of fingerprints linked with others, and (root, least) of their components."""
    found = components(links(prints.select("print"), radius)).select(F.col("node").alias("print"), "root")
    found = settle(found.unionByName(found.select(F.col("root").alias("print"), "root").distinct()), "simhash-roots")
    least = found.join(prints, "print").groupBy("root").agg(F.min("least").alias("component_id"))
    return found, least


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    A null or wordless text has fingerprint zero and links like any other. A null
    doc_id counts as larger than any; a component of such rows alone has a null
    id. Repeated rows stay; other columns are ignored; an empty table gives no row.
    """
    rows = workers_know(docs).select(F.col(doc_id).cast("long").alias("id"), _fingerprinted()(F.col(text)).alias("print"))
    rows = settle(rows, "simhash")
    prints = settle(_prints(rows), "simhash-prints")
    found, least = _roots(prints, radius)
    grouped = found.join(least, "root").select("print", "component_id")
    named = prints.join(grouped, "print", "left").select("print", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(named, "print").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = similar.SHINGLE, least: float = similar.SIMILARITY) -> DataFrame:
    """``docs`` with one row of every group of near copies, that with the smallest doc_id; all columns unchanged.

    Near copies have fingerprints within ``radius`` bits as in :func:`simhash_components`, or sets of
    ``shingle``-word shingles with a similarity of ``least`` or more, which far larger radii
    than a BK-tree can search would be needed for. A group is all that such links connect. A null
    doc_id counts as larger than any. Texts are written once; they are shuffled, by row number, only
    where the list of rows to drop or to compare is too large for Spark to broadcast.
    """
    ours = workers_know(docs).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), whole_row(docs))
    rows = ours.withColumn("print", _fingerprinted()("text")).withColumn("bands", similar.sketched(shingle)("text"))
    rows = settle(rows.select("id", "print", "bands", "_row", F.monotonically_increasing_id().alias("number")), "simhash")
    prints = settle(_prints(rows.select("id", "print")), "simhash-prints")
    found, _ = _roots(prints, radius)
    rooted = rows.select("number", "print").join(found, "print", "left").select("number", F.coalesce("root", "print").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("number").alias("b"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    equal = rooted.join(firsts, "root").select(F.col("number").alias("a"), "b")
    texts = rows.select("number", "bands", F.col("_row").getField(text).alias("text"))
    groups = components(equal.unionByName(similar.similar_links(texts, least, shingle)))
    # Rows without a group stay, and so does the first row of every group.
    named = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "number")
    ranked = rows.select("id", "number").join(named, "number").select("root", F.struct(F.col("id").isNull(), "id", "number").alias("rank"))
    ranked = settle(ranked, "simhash-groups")
    first = ranked.groupBy("root").agg(F.min("rank").alias("first"))
    dropped = settle(ranked.join(first, "root").filter("rank.number != first.number").select("rank.number"), "simhash-dropped")
    return rows.join(dropped, "number", "left_anti").select("_row.*")
