"""Language identification by the nearest of several centroids per language.

A text is lower-cased, everything but letters becomes one space, and its n-grams of one to three
characters are hashed into ``BUCKETS``. A vector is log(1 + count) times the bucket's inverse
document frequency, of length 1. Document frequencies are counted over all texts that may be
learned from. A bounded sample of each language is clustered into up to ``CENTROIDS`` groups
by their cosine (spherical k-means), one task per language; the groups' mean directions are
the centroids. A text gets the language of the centroid of highest cosine. It is rejected
if that cosine is lower than that of nearly all sampled texts of the language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import workers_know

BUCKETS, LONGEST = 1 << 13, 3
#: Rows of each language that are clustered, and languages learned (those with most rows), at most.
SAMPLE, LANGUAGES = 1200, 256
CENTROIDS, ROUNDS = 4, 10
#: Share of the sampled texts of a language that lie beyond the distance at which texts are rejected.
BEYOND = 0.005
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")
#: Characters turned into n-grams at once.
AT_ONCE = 400_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
FOUND = "struct<lang:string,score:double,rejected:boolean>"


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _pieces(text: str | None) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of a text made of words and single spaces, in pieces, and how many of their places n-grams begin at."""
    clean = f" {NO_LETTERS.sub(' ', (text or '').lower()).strip()} "
    points = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    for at in range(0, len(points), AT_ONCE):
        yield points[at : at + AT_ONCE + LONGEST - 1], min(AT_ONCE, len(points) - at)


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """(texts, ``BUCKETS``) counts of hashed n-grams, those that begin at each place of a text."""
    counts = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    some, size = [], 0
    for i, text in enumerate(texts):
        for piece, places in _pieces(text):
            some.append((i, piece, places))
            size += places
            if size >= AT_ONCE or len(some) >= 64:
                _count(counts, some)
                some, size = [], 0
    if some:
        _count(counts, some)
    return counts


def _count(counts: np.ndarray, some: list[tuple[int, np.ndarray, int]]) -> None:
    sizes = np.array([len(piece) for _, piece, _ in some])
    points = np.concatenate([piece for _, piece, _ in some]).astype(np.uint64)
    owner = np.repeat(np.arange(len(some)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # characters up to the piece's end
    begins = left > np.repeat(sizes - [places for _, _, places in some], sizes)
    hashed, keys = np.zeros(len(points), dtype=np.uint64), []
    for n in range(LONGEST):
        hashed = (hashed[: len(points) - n] * MIX[0] + points[n:] + np.uint64(n + 1)) * MIX[1]
        bucket = ((hashed ^ (hashed >> np.uint64(29))) * MIX[2] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        inside = begins[: len(bucket)] & (left[: len(bucket)] > n)
        keys.append((owner[: len(bucket)] * BUCKETS + bucket)[inside])
    found = np.bincount(np.concatenate(keys), minlength=len(some) * BUCKETS).reshape(len(some), BUCKETS)
    np.add.at(counts, [i for i, _, _ in some], found.astype(np.float32))


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length 1; zero without letters."""
    out = np.log1p(gram_counts(texts)) * idf
    length = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return np.divide(out, length, out=out, where=length > 0)


def clustered(points: np.ndarray, groups: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Directions of up to ``groups`` clusters. The first one is that of the mean; each next start is the point farthest from those before."""
    mean = points.mean(axis=0)
    centers = [points[int((points @ mean).argmax())]]
    for _ in range(min(groups, len(points)) - 1):
        nearest = (points @ np.stack(centers).T).max(axis=1)
        centers.append(points[int(nearest.argmin())])
    centers = np.stack(centers)
    for _ in range(rounds):
        own = (points @ centers.T).argmax(axis=1)
        sums = np.stack([points[own == k].sum(axis=0) if (own == k).any() else centers[k] for k in range(len(centers))])
        centers = sums / np.maximum(np.sqrt((sums**2).sum(axis=1, keepdims=True)), 1e-12)
    return centers.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _frequencies():
    """Task function: texts to (bucket, texts that have it); bucket -1 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.column(0).slice(at, 256).to_pylist()
                sums += (gram_counts(some) > 0).sum(axis=0)
                texts += len(some)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(sums[used], texts))], names=["bucket", "n"])

    return run


def _learned(idf):
    """Task function over the sampled texts of a language, at most ``SAMPLE``: its centroids and its least cosine."""

    def run(table: pa.Table) -> pa.Table:
        points = vectors(table.column("text").to_pylist(), idf.value)
        points = points[(points != 0).any(axis=1)]
        if not len(points):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary()), "least": pa.array([], pa.float64())})
        centers = clustered(points)
        least = float(np.quantile((points @ centers.T).max(axis=1), BEYOND))
        rows = len(centers)
        return pa.table({"lang": [table.column("lang")[0].as_py()] * rows, "centroid": [x.tobytes() for x in centers], "least": [least] * rows})

    return run


def fit(docs: DataFrame) -> dict:
    """The model as plain arrays: ``idf``, ``langs``, ``centroids`` and ``least``.

    ``docs`` has id, text, lang. It learns from rows with a text and a language that are not held out.
    Document frequencies cover all of them. Clustered are, of the ``LANGUAGES`` languages with most
    rows, the ``SAMPLE`` rows each whose ids hash lowest; an id with several texts gives its greatest.
    What comes to the driver is a number per bucket and ``CENTROIDS`` vectors of 32 KB per language.
    """
    known = workers_know(docs).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    df = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in known.select("text").mapInArrow(_frequencies(), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[row["bucket"]] = row["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32)
    langs = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = known.join(F.broadcast(langs), "lang").select("id", "lang").distinct()
    ids = ids.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= SAMPLE).select("id", "lang")
    # At most LANGUAGES * SAMPLE pairs of an id and a language, some MB.
    texts = known.join(F.broadcast(ids), ["id", "lang"]).groupBy("id", "lang").agg(F.max("text").alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(idf)
    learned = texts.groupBy("lang").applyInArrow(_learned(weights), "lang string, centroid binary, least double")
    rows = sorted(learned.collect(), key=lambda row: row["lang"])
    centroids = np.array([np.frombuffer(row["centroid"], dtype=np.float32) for row in rows], dtype=np.float32).reshape(len(rows), BUCKETS)
    return {"idf": idf, "langs": [row["lang"] for row in rows], "centroids": centroids, "least": np.array([row["least"] for row in rows])}


def found_by(model):
    """Column function from a text to its nearest language, the cosine (four decimals) and whether it is rejected."""

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model.value
        for batch in batches:
            langs, scores, rejected = [], [], []
            for at in range(0, len(batch), 256):
                texts = batch.slice(at, 256).to_pylist()
                if m["langs"]:
                    near = vectors(texts, m["idf"]) @ m["centroids"].T
                    best = near.argmax(axis=1)
                    cosine = near[np.arange(len(texts)), best]
                for i, text in enumerate(texts):
                    known = bool(m["langs"]) and has_letter(text)
                    langs.append(m["langs"][best[i]] if known else UNKNOWN)
                    scores.append(round(min(1.0, max(0.0, float(cosine[i]))), 4) if known else 0.0)
                    rejected.append(not known or bool(cosine[i] < m["least"][best[i]]))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["lang", "score", "rejected"])

    return found


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected.

    A null text and one without a letter are ``und``, score 0 and rejected; so is everything when
    there is nothing to learn from. A rejected text keeps its nearest language in ``lang_pred``.
    Texts are read whole, long ones in pieces; equal cosines go to the first language by name;
    repeated rows stay; an empty table gives no row; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    # Plain arrays, so that workers need not know this package to read them.
    model = workers_know(docs).sparkSession.sparkContext.broadcast(fit(rows))
    rows = rows.select("id", found_by(model)(F.col("text")).alias("found"))
    return rows.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")
