"""How far the sources of a language diverge in their words, counted by single-pass in-memory indexing.

Each task reads its texts once and keeps postings of terms in memory. When they fill
``BLOCK_POSTINGS``, they leave as a run: sorted by term, cut by hash into shards, and within a
shard into blocks of ``BLOCK_TERMS`` terms. Spark moves the blocks to their shards and sorts
them by their first term; there the runs are merged with a heap that holds the blocks which
may still have the least term. Frequencies of the terms kept are written.

The divergence of two sources sums f(p, q) over all kept terms. Most terms are missing from
most sources, and a missing one has the same p everywhere in a source. So the sum starts from
counts of counts, as if no term occurred in both sources, and only terms that occur in both
give a correction, streamed term by term.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.fold import group_starts, row_group
from .common import settle, workers_know

LEAST_DOCS, TOP_TERMS = 3, 200
SCALE = 1_000_000_000
#: Postings a task holds before they leave as a run; terms of a block.
BLOCK_POSTINGS, BLOCK_TERMS = 500_000, 256
#: Sums of pairs that a task holds before they leave; pairs that it makes at once.
HELD_PAIRS, AT_ONCE = 200_000, 500_000
#: Bytes of a text that are cut into terms at once.
CUT = 1 << 20
#: Leaves the bytes of terms, with A-Z lower-cased, and makes all others blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
RUNS = "shard int, lang string, first binary, terms array<binary>, docs array<bigint>, held array<bigint>, sources array<string>, counts array<bigint>"


def pieces_of(text: bytes | None) -> Iterator[bytes]:
    """A text in order, about ``CUT`` bytes at a time, cut between terms."""
    blank = (text or b"").translate(TERM_BYTES)
    at = 0
    while at < len(blank):
        end = blank.find(b" ", at + CUT) if at + CUT < len(blank) else -1
        end = len(blank) if end < 0 else end
        yield blank[at:end]
        at = end


def terms_of(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts in order, and the number of the text that each is in."""
    texts = [text or b"" for text in texts]
    raw = np.frombuffer(b" ".join(texts).translate(TERM_BYTES), np.uint8)
    inside = raw != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    first = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
    return terms, np.searchsorted(first, starts, "right") - 1


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each occurs."""
    keys = np.sort(keys)
    firsts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[firsts], np.diff(firsts, append=len(keys))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    key, count = np.concatenate([np.empty(0, np.int64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    firsts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[firsts], np.add.reduceat(count, firsts) if len(firsts) else count


LOW = 0xFFFFFFFF


class Postings:
    """A block in memory: per language the documents of each term, per language and source its occurrences.

    Terms, languages and groups are numbered; a posting is a key of two numbers and a count.
    """

    def __init__(self, limit: int = BLOCK_POSTINGS):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.terms: dict[bytes, int] = defaultdict(count().__next__)
        self.langs: dict[str, int] = {}
        self.groups: dict[tuple[int, str], int] = {}
        self.docs, self.posts, self.held = [], [], 0

    @property
    def full(self) -> bool:
        """Whether the block holds its limit of postings, equal ones put together."""
        if self.held >= self.limit:
            self.docs, self.posts = [_summed(*zip(*self.docs))], [_summed(*zip(*self.posts))]
            if len(self.posts[0][0]) >= self.limit // 2:
                return True
            self.held = len(self.posts[0][0])
        return False

    def add(self, langs: list[str], sources: list[str], texts: list[bytes]) -> None:
        """Whole texts, of about ``CUT`` bytes together or a single longer one, that one in pieces."""
        lang = [self.langs.setdefault(x, len(self.langs)) for x in langs]
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(lang, sources)], dtype=np.int64)
        lang, pairs = np.array(lang, dtype=np.int64), []
        for some in [[piece] for piece in pieces_of(texts[0])] if len(texts) == 1 else [texts]:
            terms, doc = terms_of(some)
            found = terms.dictionary_encode()
            number = np.fromiter(map(self.terms.__getitem__, found.dictionary.to_pylist()), np.int64, len(found.dictionary))
            term = number[found.indices.to_numpy()] if len(found) else np.empty(0, np.int64)
            self.posts.append(_counted(group[doc] << 32 | term))
            pairs.append(_counted(doc << 32 | term)[0])
            self.held += len(self.posts[-1][0])
        pair = pairs[0] if len(pairs) == 1 else _counted(np.concatenate([np.empty(0, np.int64), *pairs]))[0]
        self.docs.append(_counted(lang[pair >> 32] << 32 | pair & LOW))

    def leave(self, shards: int) -> pa.RecordBatch:
        """The block as a run, emptied: rows of ``RUNS`` by language, shard and term."""
        key, docs = _summed(*zip(*self.docs)) if self.docs else (np.empty(0, np.int64),) * 2
        post, counts = _summed(*zip(*self.posts)) if self.posts else (np.empty(0, np.int64),) * 2
        terms = sorted(self.terms)
        numbers = np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms))
        rank, shard = np.empty(len(terms), np.int64), np.empty(len(terms), np.int64)
        rank[numbers], shard[numbers] = np.arange(len(terms)), np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % shards
        lang, term = key >> 32, key & LOW
        order = np.lexsort((rank[term], shard[term], lang))
        lang, term, docs = lang[order], term[order], docs[order]
        of_group = np.array([x for x, _ in self.groups], dtype=np.int64)
        owner, of = post >> 32, post & LOW
        order = np.lexsort((owner, rank[of], shard[of], of_group[owner]))
        owner, of, counts = owner[order], of[order], counts[order]
        # Postings follow the same order, so those of a term are next to each other.
        held = np.diff(np.flatnonzero(np.diff(of_group[owner] << 32 | of, prepend=-1)), append=len(of))
        part = lang * shards + shard[term]
        runs = np.flatnonzero(np.diff(part, prepend=-1))
        within = np.arange(len(part)) - np.repeat(runs, np.diff(runs, append=len(part)))
        starts = np.flatnonzero(within % BLOCK_TERMS == 0)
        bounds = np.append(starts, len(part)).astype(np.int32)
        posts = np.concatenate([[0], np.cumsum(held)])[bounds].astype(np.int32)
        names, shown = pa.array(terms, pa.binary()), pa.array([*self.langs] or [""], pa.string())
        sources = pa.array([x for _, x in self.groups], pa.string())
        lists = [(bounds, names.take(pa.array(rank[term]))), (bounds, pa.array(docs)), (bounds, pa.array(held.astype(np.int64))), (posts, sources.take(pa.array(owner))), (posts, pa.array(counts))]
        columns = [pa.array(shard[term[starts]].astype(np.int32)), shown.take(pa.array(lang[starts])), names.take(pa.array(rank[term[starts]]))]
        columns += [pa.ListArray.from_arrays(pa.array(cuts), values) for cuts, values in lists]
        self._clear()
        return pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "first", "terms", "docs", "held", "sources", "counts"])


def indexed(shards: int, limit: int = BLOCK_POSTINGS):
    """Task function: rows (lang, source, text as bytes) to runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Postings(limit)

        def leaving() -> Iterator[pa.RecordBatch]:
            whole = block.leave(shards)
            for at in range(0, whole.num_rows, 100):
                yield whole.slice(at, 100)

        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                room = CUT + (int(sizes[at - 1]) if at else 0)
                upto = max(at + 1, int(np.searchsorted(sizes, room)))
                block.add(*(column.slice(at, upto - at).to_pylist() for column in batch.columns))
                at = upto
                if block.full:
                    yield from leaving()
        yield from leaving()

    return run


def blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[int, str, bytes, Iterator]]:
    """(shard, lang, first term, its entries) per block; an entry is (term, documents, [(source, occurrences)])."""
    terms, docs, held, sources, counts = (batch.column(i).flatten() for i in range(3, 8))
    cuts = batch.column(3).offsets.to_numpy() - batch.column(3).offsets[0].as_py()
    sizes = held.to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    terms, docs, counts = terms.to_pylist(), docs.to_numpy().tolist(), counts.to_numpy().tolist()
    sources = sources.dictionary_encode()
    names = sources.dictionary.to_pylist()
    sources = [names[i] for i in sources.indices.to_numpy().tolist()]

    def entries(a: int, b: int) -> Iterator[tuple]:
        for i in range(a, b):
            x, y = ends[i], ends[i + 1]
            yield terms[i], docs[i], zip(sources[x:y], counts[x:y])

    for shard, lang, first, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), cuts.tolist(), cuts[1:].tolist()):
        yield shard, lang, first, entries(a, b)


def heap_merged(blocks: Iterable[tuple]) -> Iterator[tuple[str, bytes, int, dict[str, int]]]:
    """(lang, term, documents, occurrences by source) by shard, language and term, from blocks in the order of their first terms.

    A block is opened when the terms before its first one have been given out, so the heap
    holds the blocks that overlap, at most about one per run.
    """
    heap: list[tuple] = []
    key, now, docs, found = None, None, 0, {}

    def until(limit: bytes | None) -> Iterator[tuple]:
        nonlocal now, docs, found
        while heap and (limit is None or heap[0][0] < limit):
            term, number, n, posts, rest = heap[0]
            if term != now:
                if now is not None:
                    yield key[1], now, docs, found
                now, docs, found = term, 0, {}
            docs += n
            for source, count in posts:
                found[source] = found.get(source, 0) + count
            following = next(rest, None)
            if following is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (following[0], number, following[1], following[2], rest))
        if limit is None and now is not None:
            yield key[1], now, docs, found
            now = None

    for number, (shard, lang, first, rest) in enumerate(blocks):
        if (shard, lang) != key:
            yield from until(None)
            key = shard, lang
        yield from until(first)
        term, n, posts = next(rest)
        heapq.heappush(heap, (term, number, n, posts, rest))
    yield from until(None)


def _merged(least: int):
    """Task function: blocks, sorted by shard, language and first term, to rows (lang, term, source, count) of kept terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, terms, sources, counts = [], [], [], []

        def left() -> pa.RecordBatch:
            columns = [pa.array(langs, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(sources, pa.string()), pa.array(counts, pa.int64())]
            for column in (langs, terms, sources, counts):
                column.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "source", "count"])

        blocks = (block for batch in batches for at in range(0, batch.num_rows, 64) for block in blocks_of(batch.slice(at, 64)))
        for lang, term, docs, found in heap_merged(blocks):
            if docs >= least:
                langs += [lang] * len(found)
                terms += [term] * len(found)
                sources += found
                counts += found.values()
                if len(terms) >= 50_000:
                    yield left()
        yield left()

    return run


def frequencies(docs: DataFrame, least: int = LEAST_DOCS, limit: int = BLOCK_POSTINGS) -> DataFrame:
    """lang, term, source, count of the terms in at least ``least`` documents of a language; written.

    A term is sent once per run, whatever its frequency, so no shard is hot. A shard has a task of its own.
    """
    shards = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = workers_know(docs).mapInArrow(indexed(shards, limit), RUNS)
    dealt = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return settle(dealt.mapInArrow(_merged(least), "lang string, term string, source string, count bigint"), "divergence-frequencies")


def _p(count, total, terms) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact for counts of any size."""
    wide = lambda x: x.cast("decimal(20,0)")
    count, total, terms = (F.col(x) if isinstance(x, str) else x for x in (count, total, terms))
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1), wide(total + terms))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """As ``_f``; p and q are at most 1 + ``SCALE``, so squares fit into 64 bits."""
    return (p - q) * (p - q) // q


class PairSums:
    """Sums over the terms that two sources share, per (lang, source, item): how many, and the corrections of f."""

    def __init__(self):
        self.codes: dict[tuple[str, str], int] = {}
        self.named: list[tuple[str, str]] = []
        self.sums: dict[int, list[int]] = {}

    def code(self, batch: pa.RecordBatch) -> np.ndarray:
        """A number for each row's language and source."""
        langs, sources = (batch.column(name).dictionary_encode() for name in ("lang", "source"))
        both = langs.indices.to_numpy().astype(np.int64) << 32 | sources.indices.to_numpy()
        distinct, inverse = np.unique(both, return_inverse=True)
        out = np.empty(len(distinct), dtype=np.int64)
        for i, x in enumerate(distinct.tolist()):
            key = langs.dictionary[x >> 32].as_py(), sources.dictionary[x & 0xFFFFFFFF].as_py()
            if key not in self.codes:
                self.codes[key] = len(self.named)
                self.named.append(key)
            out[i] = self.codes[key]
        return out[inverse]

    def add(self, code: np.ndarray, p: np.ndarray, p0: np.ndarray, starts: np.ndarray) -> None:
        """Postings of whole terms; ``starts`` are the first of each. At most about ``AT_ONCE`` pairs are held at a time."""
        sizes = np.diff(starts, append=len(code))
        first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        ends = np.cumsum(size)
        at = 0
        while at < len(code):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + AT_ONCE)))
            n = size[at:upto]
            left = np.repeat(np.arange(at, upto), n)
            right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:upto], n)
            left, right = left[left != right], right[left != right]
            at = upto
            if not len(left):
                continue
            value = f_of(p[left], p[right]) - f_of(p[left], p0[right]) - f_of(p0[left], p[right])
            key = code[left] << 32 | code[right]
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            cuts = np.flatnonzero(np.diff(key, prepend=-1))
            for k, n_, x in zip(key[cuts].tolist(), np.diff(cuts, append=len(key)).tolist(), np.add.reduceat(value, cuts).tolist()):
                held = self.sums.setdefault(k, [0, 0])
                held[0] += n_
                held[1] += x

    def left(self) -> pa.RecordBatch:
        """What has been summed up, emptied."""
        rows = []
        for k, value in self.sums.items():
            (lang, source), (_, item) = self.named[k >> 32], self.named[k & 0xFFFFFFFF]
            rows.append((lang, source, item, *value))
        self.sums = {}
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = [pa.array(column, kind) for column, kind in zip([*zip(*rows)] or [[]] * 5, kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "both", "value"])


def _corrections():
    """Task function: postings with p and p0, those of a term next to each other, to sums per (lang, source, item).

    ``both`` counts the terms that both have, ``value`` sums f(pa, pb) - f(pa, p0b) - f(p0a, pb).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, key = PairSums(), (np.empty(0, np.int64),) * 3, None
        for batch in batches:
            if not batch.num_rows:
                continue
            opens = group_starts(batch, ("lang", "term"), key)
            key = row_group(batch, ("lang", "term"), batch.num_rows - 1)
            now = (sums.code(batch), *(batch.column(name).to_numpy() for name in ("p", "p0")))
            starts = np.flatnonzero(opens) + len(held[0])
            starts = np.concatenate([[0], starts]) if len(held[0]) else starts
            now = tuple(np.concatenate([a, b]) for a, b in zip(held, now))
            last = int(starts[-1])
            sums.add(*(x[:last] for x in now), starts[:-1])
            held = tuple(x[last:] for x in now)
            if len(sums.sums) >= HELD_PAIRS:
                yield sums.left()
        sums.add(*held, np.zeros(min(1, len(held[0])), np.int64))
        yield sums.left()

    return run


class Audit:
    """The tables behind the audit: ``groups`` (lang, source, total, terms, p0, own) and ``postings`` (with p, p0, q)."""

    def __init__(self, docs: DataFrame, least: int = LEAST_DOCS, limit: int = BLOCK_POSTINGS):
        named = docs.select(*[F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")])
        counts = frequencies(named.select("lang", "source", F.col("text").cast("binary").alias("text")), least, limit)
        by_term = counts.groupBy("lang", "term").agg(F.sum("count").alias("count"))
        langs = settle(by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("count").alias("lang_total")), "divergence-langs")
        sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("own"))
        groups = named.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.na.fill(0, ["total", "own", "terms", "lang_total"])
        # Written tables tell their size; there is a row per source and language.
        self.groups = settle(groups.withColumn("p0", F.when(F.col("terms") > 0, _p(F.lit(0), "total", "terms"))), "divergence-groups")
        self.counts, self.by_term = counts, by_term
        sides = self.groups.select("lang", "source", "total", "terms", "p0", "lang_total")
        joined = counts.join(sides, ["lang", "source"])
        self.postings = joined.select("lang", "term", "source", "count", "lang_total", "terms", _p("count", "total", "terms").alias("p"), "p0")

    def pairs(self) -> DataFrame:
        """lang, source, item, value for each source against each other one of its language."""
        groups = self.groups
        other = groups.select("lang", F.col("source").alias("item"), F.col("own").alias("item_own"), F.col("p0").alias("item_p0"))
        apart = F.col("source") != F.col("item")
        pairs = groups.join(other, "lang").filter(apart).select("lang", "source", "item", "terms", "own", "item_own", "p0", "item_p0")
        # Counts of counts: terms of a source by their p, against sources without them.
        shape = self.postings.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"), F.first("p0").alias("p0"))
        against = shape.join(other, "lang").filter(apart)
        wide = lambda x: x.cast("decimal(38,0)")
        p, n = F.col("p"), wide(F.col("n"))
        both_ways = F.array(
            F.struct(F.col("source").alias("source"), F.col("item").alias("item"), (n * wide(_f(p, F.col("item_p0")))).cast("decimal(38,0)").alias("value")),
            F.struct(F.col("item").alias("source"), F.col("source").alias("item"), (n * wide(_f(F.col("item_p0"), p))).cast("decimal(38,0)").alias("value")),
        )
        single = against.select("lang", F.inline(both_ways)).select("lang", "source", "item", F.lit(0).cast("long").alias("both"), "value")
        streamed = self.postings.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
        corrected = streamed.mapInArrow(_corrections(), "lang string, source string, item string, both bigint, value bigint")
        corrected = corrected.withColumn("value", wide(F.col("value")))
        sums = single.unionByName(corrected).groupBy("lang", "source", "item").agg(F.sum("both").alias("both"), F.sum("value").alias("value"))
        whole = pairs.join(sums, ["lang", "source", "item"], "left").na.fill(0, ["both"])
        missing = wide(F.col("terms") - F.col("own") - F.col("item_own") + F.col("both"))
        # Without kept terms p0 is null, and so is the sum.
        value = F.coalesce(missing * wide(_f(F.col("p0"), F.col("item_p0"))) + F.coalesce("value", wide(F.lit(0))), wide(F.lit(0)))
        return whole.select("lang", "source", "item", value.cast("long").alias("value"))

    def terms(self) -> DataFrame:
        """lang, source, item, value for the terms that a source has more often than its language."""
        whole = self.by_term.select("lang", "term", F.col("count").alias("lang_count"))
        joined = self.postings.join(whole, ["lang", "term"]).withColumn("q", _p("lang_count", "lang_total", "terms"))
        return joined.filter("p > q").select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS, limit: int = BLOCK_POSTINGS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` against every other source, part ``term`` the ``top`` terms of each.

    Null text, lang and source count as empty. A group without terms has its pairs; a language without
    kept terms has pairs of value 0. Ties are ranked by the bytes of the item; repeated rows count as
    often as they occur; a text is read whole, a piece at a time; an empty table gives no row;
    other columns are ignored. ``limit`` bounds the postings a task holds, not what is counted.
    """
    audit = Audit(docs, least, limit)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(audit.pairs(), "pair").unionByName(ranked(audit.terms(), "term").filter(F.col("rank") <= top))
