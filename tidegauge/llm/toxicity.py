"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network as its own and its characters' evidence (smoothed log odds
of the word and of its character 4-grams between the two labels of the training rows)
and as learned vectors for hash buckets of the word and of its first characters. Two
gated recurrent layers read a window of ``WIDTH`` words from either side, attention
pools their states into one number. Windows overlap and cover every text whole; a
text scores as its worst window. Training takes the windows that score highest in
each text, since a label speaks of the text and not of all of its windows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACED, whole_row, workers_know

WIDTH, STEP = 32, 24
HIDDEN, ATTENTION, BUCKETS, LEARNED, GRAM, START = 8, 8, 1024, 3, 4, 4
EVIDENCE = 4
#: Training rows of each label at most, chosen by hash. All windows of their texts are taken.
SAMPLE = 2000
#: Every round takes as many steps of ``BATCH`` windows, however small the sample.
ROUNDS, STEPS, BATCH, RATE, DECAY, SEEN_IN = 5, 90, 128, 0.01, 1.0, 3
THRESHOLD = 0.7
#: Score of a text without words, which carries no evidence.
EMPTY_SCORE = 0.0
#: Words a worker remembers, 192 bytes each beside the word, and characters of the texts that it scores together, one text at least.
REMEMBERED, CHARACTERS = 200_000, 1_000_000
AT_ONCE = 4096


def words_of(text: str | None) -> list[str]:
    return SPACED.findall((text or "").lower())


def grams(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))]


def starts_of(count: int) -> list[int]:
    """Starts of overlapping windows that cover ``count`` words; the last ends with the text."""
    if count <= WIDTH:
        return [0] if count else []
    return [*range(0, count - WIDTH, STEP), count - WIDTH]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Sample:
    """Training windows as word numbers, four bytes a word, in the order of row and words.

    ``windows`` is padded with the size of the vocabulary, which is sorted.
    """

    vocabulary: list[str]
    owner: np.ndarray
    labels: np.ndarray
    windows: np.ndarray

    @staticmethod
    def of(rows: Iterable[tuple[int, int, list[str]]]) -> Sample:
        """From (row, label, words), taken one at a time."""
        number: dict[str, int] = {}
        owner, labels, sizes, flat = array("q"), array("i"), array("i"), array("i")
        for row, label, words in rows:
            owner.append(row)
            labels.append(label)
            sizes.append(len(words))
            flat.extend([number.setdefault(word, len(number)) for word in words])
        vocabulary = sorted(number)
        rank = np.empty(len(number), dtype=np.int32)
        rank[[number[word] for word in vocabulary]] = np.arange(len(number), dtype=np.int32)
        owners, sides, lengths = np.array(owner, np.int64), np.array(labels, np.int32), np.array(sizes, np.int32)
        windows = np.full((len(owners), WIDTH), len(vocabulary), dtype=np.int32)
        windows[np.arange(WIDTH) < lengths[:, None]] = rank[np.array(flat, np.int32)]
        order = np.lexsort((*windows.T[::-1], owners))
        return Sample(vocabulary, owners[order], sides[order], windows[order])

    def firsts(self) -> np.ndarray:
        """Where the windows of each row begin."""
        return np.flatnonzero(np.diff(self.owner, prepend=self.owner[0] - 1))

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """Label and distinct word numbers of each row."""
        firsts = self.firsts().tolist()
        for a, b in zip(firsts, [*firsts[1:], len(self.owner)]):
            found = np.unique(self.windows[a:b])
            yield int(self.labels[a]), found[found < len(self.vocabulary)]


@dataclass
class Evidence:
    """Log odds of words and of character n-grams, shrunk where few rows have them."""

    words: dict[str, float]
    grams: dict[str, float]

    @staticmethod
    def learn(sample: Sample) -> Evidence:
        """Counts rows, one after the other, by numbers; only counts are held for all rows."""
        number: dict[str, int] = {}
        parts = [np.unique([number.setdefault(g, len(number)) for g in grams(word)]) for word in sample.vocabulary]
        words, pieces = np.zeros((2, len(parts)), np.int64), np.zeros((2, len(number)), np.int64)
        rows = np.zeros(2, np.int64)
        for side, found in sample.rows():
            rows[side] += 1
            words[side, found] += 1
            pieces[side, np.unique(np.concatenate([parts[i] for i in found]))] += 1

        def odds(names, counts: np.ndarray) -> dict[str, float]:
            both, (zeros, ones) = counts.sum(axis=0), np.maximum(rows, 1)
            value = np.log((counts[1] + 0.5) / (ones + 1)) - np.log((counts[0] + 0.5) / (zeros + 1))
            value = value * both / (both + 8) / 3
            return {name: x for name, x, n in zip(names, value.tolist(), both.tolist()) if n >= SEEN_IN}

        return Evidence(odds(sample.vocabulary, words), odds(number, pieces))

    def of(self, word: str) -> tuple[float, float, float, float]:
        marked, get = f"^{word}$", self.grams.get
        found = [get(marked[i : i + GRAM], 0.0) for i in range(max(1, len(marked) - GRAM + 1))]
        return self.words.get(word, 0.0), max(found), min(found), sum(found) / len(found)


class Network:
    """The network and its gradient. Parameters are plain arrays, words are rows of a table."""

    def __init__(self, evidence: Evidence, seed: int = 7):
        self.evidence, size = evidence, EVIDENCE + 2 * LEARNED
        rng = np.random.default_rng(seed)
        mat = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"word": mat(BUCKETS, LEARNED), "start": mat(BUCKETS, LEARNED)}
        for side in "fb":
            self.p |= {f"w{side}": mat(size, 3 * HIDDEN), f"u{side}": mat(HIDDEN, 3 * HIDDEN), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": mat(2 * HIDDEN, ATTENTION), "d": np.zeros(ATTENTION, np.float32), "v": mat(ATTENTION, 1)[:, 0], "o": mat(2 * HIDDEN, 1)[:, 0], "e": np.zeros(1, np.float32)}

    @staticmethod
    def of(words: dict[str, float], grams: dict[str, float], parameters: dict[str, np.ndarray]) -> Network:
        """A trained network from its parts."""
        out = Network(Evidence(words, grams))
        out.p = parameters
        return out

    def table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Evidence and the two buckets of each word. The last row stands for padding."""
        facts = np.array([*map(self.evidence.of, words), (0.0,) * EVIDENCE], dtype=np.float32)
        starts = [x[:START] for x in words]
        of = {x: zlib.crc32(x.encode()) % BUCKETS for x in set(starts)}
        whole = np.array([*(zlib.crc32(x.encode()) % BUCKETS for x in words), 0])
        return facts, whole, np.array([*map(of.__getitem__, starts), 0])

    def vectors(self, table) -> np.ndarray:
        facts, word, start = table
        return np.concatenate([facts, self.p["word"][word], self.p["start"][start]], axis=1)

    def _run(self, projected: np.ndarray, u: np.ndarray, windows: np.ndarray, mask: np.ndarray, order, keep: list | None) -> np.ndarray:
        """States of one direction, (steps, windows, HIDDEN)."""
        h = np.zeros((len(windows), HIDDEN), np.float32)
        out = np.empty((windows.shape[1], len(windows), HIDDEN), np.float32)
        for t in order:
            x, r = projected[windows[:, t]], h @ u
            gates = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])))
            z, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + reset * r[:, 2 * HIDDEN :])
            m = mask[:, t, None]
            after = h + m * (1 - z) * (c - h)
            if keep is not None:
                keep.append((t, h, z, reset, c, r[:, 2 * HIDDEN :], m))
            h = out[t] = after
        return out

    def forward(self, table, windows: np.ndarray, keep: dict | None = None, projected=None, pad: int | None = None) -> np.ndarray:
        """Logits of windows, given as rows of word numbers; ``pad``, or else the table's last row, is padding."""
        p, mask = self.p, (windows != (len(table[0]) - 1 if pad is None else pad)).astype(np.float32)
        x = self.vectors(table) if projected is None else None
        projected = self.projected(x) if projected is None else projected
        steps = range(windows.shape[1])
        traces = ([], []) if keep is not None else (None, None)
        f = self._run(projected[0], p["uf"], windows, mask, steps, traces[0])
        b = self._run(projected[1], p["ub"], windows, mask, reversed(steps), traces[1])
        h = np.concatenate([f, b], axis=2)
        q = np.tanh(h @ p["a"] + p["d"])
        scores = np.where(mask.T > 0, q @ p["v"], -1e9)
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        pooled = (weights[:, :, None] * h).sum(axis=0)
        if keep is not None:
            keep |= {"x": x, "traces": traces, "h": h, "q": q, "weights": weights, "pooled": pooled}
        return pooled @ p["o"] + p["e"][0]

    def projected(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(x @ self.p[f"w{side}"] + self.p[f"c{side}"] for side in "fb")

    def gradient(self, table, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, k = self.p, {}
        error = (_sigmoid(self.forward(table, windows, k)) - labels).astype(np.float32) / len(labels)
        g = {name: np.zeros_like(value) for name, value in p.items()}
        g["o"], g["e"] = k["pooled"].T @ error, np.array([error.sum()], np.float32)
        d_pooled = error[:, None] * p["o"]
        d_h = k["weights"][:, :, None] * d_pooled
        d_weights = (k["h"] * d_pooled).sum(axis=2)
        d_scores = k["weights"] * (d_weights - (k["weights"] * d_weights).sum(axis=0))
        g["v"] = (k["q"] * d_scores[:, :, None]).sum(axis=(0, 1))
        d_q = d_scores[:, :, None] * p["v"] * (1 - k["q"] ** 2)
        g["a"], g["d"] = np.einsum("tbi,tbj->ij", k["h"], d_q), d_q.sum(axis=(0, 1))
        d_h = d_h + d_q @ p["a"].T
        d_x = np.zeros_like(k["x"])
        for side, trace, part in zip("fb", k["traces"], (d_h[:, :, :HIDDEN], d_h[:, :, HIDDEN:])):
            carried, u = np.zeros_like(part[0]), p[f"u{side}"]
            d_projected = np.zeros((len(k["x"]), 3 * HIDDEN), np.float32)
            for t, h, z, reset, c, r, m in reversed(trace):
                after = part[t] + carried
                d_c = after * m * (1 - z) * (1 - c**2)
                d_z = after * m * (h - c) * z * (1 - z)
                d_reset = d_c * r * reset * (1 - reset)
                d_in = np.concatenate([d_z, d_reset, d_c], axis=1)
                d_r = np.concatenate([d_z, d_reset, d_c * reset], axis=1)
                np.add.at(d_projected, windows[:, t], d_in)
                g[f"u{side}"] += h.T @ d_r
                carried = after * (1 - m * (1 - z)) + d_r @ u.T
            g[f"w{side}"], g[f"c{side}"] = k["x"].T @ d_projected, d_projected.sum(axis=0)
            d_x += d_projected @ p[f"w{side}"].T
        np.add.at(g["word"], table[1], d_x[:, EVIDENCE : EVIDENCE + LEARNED])
        np.add.at(g["start"], table[2], d_x[:, EVIDENCE + LEARNED :])
        return g


def train(rows: Iterable[tuple[int, int, list[str]]], seed: int = 7) -> Network | None:
    """A network from windows (row, label, words). None unless both labels occur."""
    sample = Sample.of(rows)
    if len(np.unique(sample.labels)) < 2:
        return None
    network = Network(Evidence.learn(sample), seed)
    vocabulary, windows, owner = sample.vocabulary, sample.windows, sample.owner
    labels = sample.labels.astype(np.float32)
    table, first = network.table(vocabulary), sample.firsts()
    scores = table[0][:, :2].max(axis=1)[windows].max(axis=1)
    rng, moments, step = np.random.default_rng(seed), {}, 0
    for _ in range(ROUNDS):
        worst = np.lexsort((-scores, owner))[first]
        chosen = np.concatenate([worst, rng.choice(np.flatnonzero(labels == 0), len(worst) // 2)])
        for _ in range(STEPS):
            some = rng.choice(chosen, min(BATCH, len(chosen)), replace=False)
            used, inner = np.unique(windows[some], return_inverse=True)
            used = used if used[-1] == len(vocabulary) else np.append(used, len(vocabulary))
            step += 1
            for name, value in network.gradient(tuple(x[used] for x in table), inner.reshape(len(some), WIDTH), labels[some]).items():
                m, v = moments.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
                m += 0.1 * (value - m)
                v += 0.001 * (value**2 - v)
                if name in ("word", "start"):
                    network.p[name] *= 1 - RATE * DECAY
                network.p[name] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        projected = network.projected(network.vectors(table))
        scores = np.concatenate([network.forward(table, windows[i : i + AT_ONCE], projected=projected) for i in range(0, len(windows), AT_ONCE)])
    return network


class Scorer:
    """Scores of whole texts: the highest probability among a text's windows.

    What the network needs of a word is kept in one array that grows in place; its first row stands
    for padding. When it holds ``REMEMBERED`` words it starts anew.
    """

    def __init__(self, network: Network | None):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.facts = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        first = len(self.number) + 1
        self.number.update(zip(words, range(first, first + len(words))))
        while self.facts.shape[1] <= len(self.number):
            grown = np.zeros((2, min(2 * self.facts.shape[1], self.facts.shape[1] + 65_536), 3 * HIDDEN), np.float32)
            grown[:, : self.facts.shape[1]] = self.facts
            self.facts = grown
        for side, values in enumerate(self.network.projected(self.network.vectors(self.network.table(words)))):
            self.facts[side, first : first + len(words)] = values[:-1]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        scores = np.full(len(texts), EMPTY_SCORE)
        if self.network is None:
            return scores
        owners, windows, used = [], np.zeros((AT_ONCE, WIDTH), dtype=np.int64), 0
        for i, text in enumerate(texts):
            words = words_of(text)
            new = [word for word in dict.fromkeys(words) if word not in self.number]
            if len(self.number) + len(new) > REMEMBERED and self.number:
                self._score(owners, windows[:used], scores)  # by the numbers of words now forgotten
                owners, used = [], 0
                self._forget()
                new = [*dict.fromkeys(words)]
            for at in range(0, len(new), 50_000):
                self._learn(new[at : at + 50_000])
            numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
            for start in starts_of(len(words)):
                some = numbers[start : start + WIDTH]
                windows[used, : len(some)], windows[used, len(some) :] = some, 0
                owners.append(i)
                used += 1
                if used == AT_ONCE:
                    self._score(owners, windows, scores)
                    owners, used = [], 0
        self._score(owners, windows[:used], scores)
        return scores

    def _score(self, owners: list[int], windows: np.ndarray, scores: np.ndarray) -> None:
        if owners:
            found = _sigmoid(self.network.forward(None, windows, projected=self.facts, pad=0)).astype(np.float64)
            np.maximum.at(scores, owners, found)

    def all(self, texts: pa.Array) -> np.ndarray:
        """Scores of a batch, some texts of ``CHARACTERS`` together at a time."""
        out, some, size = [np.empty(0)], [], 0
        for text in texts:
            some.append(text.as_py())
            size += len(some[-1] or "")
            if size >= CHARACTERS:
                out.append(self(some))
                some, size = [], 0
        return np.concatenate([*out, self(some)])


def _windows():
    """All windows of each training row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, label, text in zip(*batch.columns):
                words = words_of(text.as_py())
                cut = [" ".join(words[start : start + WIDTH]) for start in starts_of(len(words))]
                columns = [pa.repeat(row, len(cut)), pa.repeat(label, len(cut)), pa.array(cut, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "words"])

    return run


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Network | None:
    """A network from all windows of at most ``SAMPLE`` labelled rows of each label.

    The sample takes the documents whose ids hash lowest, from those that are labelled and not held
    out; labels without a document count for nothing. An id with two labels counts as toxic if one
    is, one with several texts gives its greatest. On the driver a word of the sample takes about six bytes.
    """
    known = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1) AND id IS NOT NULL")
    known = known.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    rows = workers_know(docs).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    known = known.join(rows.select("id").distinct(), "id", "left_semi")
    # The lowest hashes of each label; both lists are bounded by SAMPLE.
    parts = [known.filter(F.col("label") == side).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for side in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    one_text = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("label").alias("label"), F.max("text").alias("text"))
    cut = one_text.select("id", "label", "text").mapInArrow(_windows(), "id long, label int, words string")
    return train((row.id, row.label, row.words.split(" ")) for row in cut.toLocalIterator())


def _scores(spark: SparkSession, network: Network | None):
    """Column function from a text to its score. The network, some hundred kB to a few MB as bounded
    by the training sample, goes to the workers as plain dictionaries and arrays, which need no package there."""
    parts = network and (network.evidence.words, network.evidence.grams, network.p)
    model = spark.sparkContext.broadcast(parts)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = Scorer(model.value and Network.of(*model.value))
        for batch in batches:
            yield pa.array(of.all(batch))

    return score


def scored(docs: DataFrame, network: Network | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row, by the whole text alone.

    A null or wordless text scores ``EMPTY_SCORE``; so does everything if training
    rows of both labels were not to be had. Repeated rows score alike; an empty table gives no row.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    return workers_know(docs).withColumn(name, _scores(docs.sparkSession, network)(F.col(f"`{text}`")))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Other columns are ignored."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = scored(rows, fit(docs, labels, doc_id, text))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns unchanged.

    Rows without words stay, and so does all if there is nothing to learn from. Repeated rows stay or go
    alike; an empty table gives an empty one; columns of any name are kept.
    """
    network = fit(docs, labels, doc_id, text)
    rows = workers_know(docs).select(whole_row(docs))  # holds the text once
    score = _scores(docs.sparkSession, network)(F.col("_row").getField(text))
    return rows.withColumn("score", score).filter(F.col("score") < threshold).select("_row.*")
