"""Exact duplicates by composable polynomial fingerprints and a comparison chunk by chunk.

The fingerprint of a text of n bytes is sum((byte + 1) * base ** (n - 1 - i)) modulo
three primes. Chunks are hashed independently of each other, all at once, and two
neighbours combine by shifting the left one: left * base ** length(right) + right.
A fingerprint only proposes equality; every text of a group is then compared with
the group's representative. One that differs (a collision) is grouped by its SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, settle, whole_row, workers_know

PRIMES = (2**31 - 1, 2**31 - 19, 2**31 - 61)
CHUNK = 1024
#: Bytes hashed at once; a multiple of ``CHUNK``.
HASHED = 1 << 21
COMPARED = 65_536
#: Copies that share one copy of their representative's text in the comparison.
COPIES_PER_SALT = 1000
PRINT = "struct<print:string,bytes:bigint,sha:string>"


class Fingerprints:
    """Fingerprints modulo ``primes``. Fewer or smaller primes collide; tests use that."""

    def __init__(self, primes: tuple[int, ...] = PRIMES):
        self.primes = primes
        self.bases = [int.from_bytes(hashlib.sha256(b"base %d" % p).digest()[:4], "big") % p for p in primes]
        self.powers = np.array([[pow(base, CHUNK - 1 - i, p) for i in range(CHUNK)] for base, p in zip(self.bases, primes)], dtype=np.uint64).T

    def chunks(self, data: bytes) -> np.ndarray:
        """A row of hashes per chunk. The first chunk is the short one, so that all others shift alike."""
        count = max(1, -(-len(data) // CHUNK))
        values = np.zeros(count * CHUNK, dtype=np.uint64)
        if data:
            values[-len(data) :] = np.frombuffer(data, dtype=np.uint8)
            values[-len(data) :] += np.uint64(1)
        return (values.reshape(count, CHUNK) @ self.powers) % np.array(self.primes, dtype=np.uint64)

    def combine(self, left: Iterable[int], right: Iterable[int], right_bytes: int) -> tuple[int, ...]:
        """The fingerprint of left followed by right, from theirs."""
        return tuple((int(a) * pow(base, right_bytes, p) + int(b)) % p for a, b, base, p in zip(left, right, self.bases, self.primes))

    def _piece(self, data: bytes) -> tuple[int, ...]:
        hashes = self.chunks(data)
        out = tuple(int(x) for x in hashes[0])
        shifts = [pow(base, CHUNK, p) for base, p in zip(self.bases, self.primes)]
        for row in hashes[1:]:
            out = tuple((a * shift + int(b)) % p for a, shift, b, p in zip(out, shifts, row, self.primes))
        return out

    def __call__(self, data: bytes) -> tuple[int, ...]:
        """Pieces of ``HASHED`` bytes, one after the other, so that a huge text takes no more memory than they do."""
        out = self._piece(data[:HASHED])
        for at in range(HASHED, len(data), HASHED):
            piece = data[at : at + HASHED]
            out = self.combine(out, self._piece(piece), len(piece))
        return out


def same_text(left: str, right: str) -> bool:
    """Chunk by chunk up to the first difference; A-Z count as lower case."""
    a, b = memoryview(left.encode()), memoryview(right.encode())
    if len(a) != len(b):
        return False
    return all(bytes(a[i : i + COMPARED]).translate(LOWER) == bytes(b[i : i + COMPARED]).translate(LOWER) for i in range(0, len(a), COMPARED))


def _printed(primes: tuple[int, ...]):
    @F.arrow_udf(PRINT)
    def printed(texts: pa.Array) -> pa.Array:
        prints, sizes, shas, of = [], [], [], Fingerprints(primes)
        for text in texts:
            data = (text.as_py() or "").encode().translate(LOWER)
            prints.append("".join(f"{x:08x}" for x in of(data)))
            sizes.append(len(data))
            shas.append(hashlib.sha256(data).hexdigest())
        return pa.StructArray.from_arrays([pa.array(prints, pa.string()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())], ["print", "bytes", "sha"])

    return printed


def _compared():
    @F.arrow_udf("boolean")
    def compared(texts: pa.Array, others: pa.Array) -> pa.Array:
        return pa.array([same_text(a.as_py() or "", b.as_py() or "") for a, b in zip(texts, others)], pa.bool_())

    return compared


def _numbered(docs: DataFrame, doc_id: str, text: str, whole: bool, primes: tuple[int, ...]) -> DataFrame:
    """A written table of all rows: number, id, print, bytes, sha, and the text (with ``whole`` all columns, which hold it)."""
    body = whole_row(docs) if whole else F.col(text).alias("words")
    rows = workers_know(docs).select(F.col(doc_id).cast("long").alias("id"), body)
    rows = rows.withColumn("f", _printed(primes)(_words(text, whole)))
    return settle(rows.select("id", "f.*", F.monotonically_increasing_id().alias("number"), "_row" if whole else "words"), "exact-prints")


def _words(text: str, whole: bool) -> Column:
    return F.col("_row").getField(text) if whole else F.col("words")


def _members(rows: DataFrame, words: Column) -> DataFrame:
    """A written table of rows that share their fingerprint with another one: number, id, print, bytes, sha, copies, top, words.

    Texts are shuffled once, by row number, so a large group lies in no one task.
    """
    groups = rows.groupBy("print", "bytes").agg(F.count(F.lit(1)).alias("copies"), F.max("id").alias("top")).filter("copies > 1")
    # Written tables tell their size, by which Spark chooses to broadcast or to shuffle.
    groups = settle(groups, "exact-groups")
    members = rows.select("number", "id", "print", "bytes", "sha").join(groups, ["print", "bytes"])
    return settle(members.hint("merge").join(rows.select("number", words.alias("words")), "number"), "exact-members")


def _classes(members: DataFrame) -> DataFrame:
    """Members with their kind. Equal texts, and only they, agree in print, bytes and kind.

    A representative is sent to as many tasks as its group needs, one for every ``COPIES_PER_SALT`` copies.
    """
    salts = F.ceil(F.col("copies") / COPIES_PER_SALT)
    heads = members.filter(F.col("id").eqNullSafe(F.col("top"))).groupBy("print", "bytes").agg(F.first("words").alias("head"), F.first("copies").alias("copies"))
    heads = heads.select("print", "bytes", "head", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    pairs = members.withColumn("salt", F.pmod(F.xxhash64("number"), salts)).join(heads, ["print", "bytes", "salt"])
    kind = F.when(_compared()("words", "head"), F.lit("")).otherwise(F.col("sha"))
    return settle(pairs.select("number", "id", "print", "bytes", "sha", kind.alias("kind")), "exact-classes")


def _kept(classes: DataFrame) -> DataFrame:
    best = F.max(F.struct("id", "number"))
    return classes.groupBy("print", "bytes", "kind").agg(best.alias("best"), F.count(F.lit(1)).alias("size"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The largest doc_id of a group stays; a null doc_id is smaller than any. Of
    rows that repeat both doc_id and text one stays. Other columns are ignored;
    an empty table gives no row.
    """
    rows = _numbered(docs, doc_id, text, False, primes)
    members = _members(rows, _words(text, False))
    classes = _classes(members)
    alone = rows.select("number", "id", "sha").join(members.select("number"), "number", "left_anti").select(
        F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")
    )
    grouped = classes.join(_kept(classes), ["print", "bytes", "kind"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("number") == F.col("best.number")).alias("kept"), F.col("sha").alias("text_sha256")
    )
    return alone.unionByName(grouped)


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns unchanged.

    Whole rows are written once, and shuffled by row number only where the rows to drop are too many to be broadcast.
    """
    rows = _numbered(docs, doc_id, text, True, primes)
    classes = _classes(_members(rows, _words(text, True)))
    kept = _kept(classes).select(F.col("best.number").alias("kept"))
    dropped = settle(classes.join(kept, F.col("number") == F.col("kept"), "left_anti").select("number"), "exact-dropped")
    return rows.join(dropped, "number", "left_anti").select("_row.*")
