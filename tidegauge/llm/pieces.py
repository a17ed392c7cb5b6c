"""SentencePiece (BPE) encoding and decoding by matching all pieces in a suffix array.

The texts of a batch are cut into units (a run of spaces and what follows it), which pieces never
cross; units not met before are put one after the other into one string. Its suffixes are
sorted, every piece of the vocabulary is found by binary search as a range of suffixes, and each
suffix of the range is an edge from its place to the piece's end. Edges are sorted by their end and
relaxed in that order: the last piece of a prefix's encoding is the one edge whose start is
encoded and whose piece stays apart from the piece before, that is, merging the two as BPE
does would not cross between them. So the result is that of merging by rank, not a
segmentation of highest score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, kept, workers_know

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Bytes of units that a worker remembers. Characters indexed at once, at least one unit; an index takes some 640 bytes each.
REMEMBERED, INDEXED = 80 << 20, 100_000
#: Units from this length on are cut between characters that no piece has next to each other.
LONG_UNIT = 64
#: Characters of the texts that are encoded together, one text at least.
CHARACTERS = 1_000_000
MEMO = 1 << 20


class Vocabulary:
    """Pieces, their ranks and how each comes from two others by merging."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.unknown = model.unk_id()
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.special = special
        self.ids = {piece: i for i, piece in enumerate(self.pieces) if i not in special}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece crosses a space, so texts cannot be cut there")
        self.scores = np.array([model.get_score(i) for i in range(size)])
        merged = sorted((i for i in self.ids.values() if len(self.pieces[i]) > 1), key=lambda i: (-self.scores[i], i))
        #: 0 for single characters, then in the order of merging.
        self.rank = np.zeros(size + 1, dtype=np.int64)
        self.rank[merged] = np.arange(1, len(merged) + 1)
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        pairs = []
        for i in merged:
            piece = self.pieces[i]
            halves = [(a, b) for k in range(1, len(piece)) if (a := self.ids.get(piece[:k])) is not None and (b := self.ids.get(piece[k:])) is not None]
            pairs += [((a << 32) | b, self.rank[i]) for a, b in halves]
            # The merge that makes it is the last step of encoding the piece itself.
            if halves:
                self.left[i], self.right[i] = self._split(piece, halves)
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], dtype=np.int64)
        self.longest = max(map(len, self.ids))
        #: Pairs of characters within a piece.
        self.inner = np.array(sorted({(ord(a) << 21) | ord(b) for piece in self.ids for a, b in zip(piece, piece[1:])}), dtype=np.int64)

    def _split(self, piece: str, halves: list[tuple[int, int]]) -> tuple[int, int]:
        if len(halves) == 1:
            return halves[0]
        parts = [self.ids.get(c) for c in piece]
        if None in parts:
            return halves[0]
        while len(parts) > 2:
            best = min(((self.rank[m], k) for k in range(len(parts) - 1) if (m := self.ids.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]])) is not None), default=None)
            if best is None:
                return halves[0]
            k = best[1]
            parts[k : k + 2] = [self.ids[self.pieces[parts[k]] + self.pieces[parts[k + 1]]]]
        return (parts[0], parts[1]) if len(parts) == 2 else halves[0]

    def joint_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank at which neighbours a and b would merge, or a very large number."""
        keys = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.iinfo(np.int64).max)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b, next to each other, come out of merging as just these two.

        Taken back step by step, the merge of higher rank first: at each step the two
        parts that touch must not merge before the step that made one of them.
        """
        out = np.ones(len(a), dtype=bool)
        live, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            joint = self.joint_rank(a, b)
            ranks_a, ranks_b = self.rank[a], self.rank[b]
            # A tie goes to the leftmost: the right piece's own merge comes later in the text.
            from_right = ranks_b >= ranks_a
            crossed = joint < limit
            out[live[crossed]] = False
            whole = (ranks_a == 0) & (ranks_b == 0)
            on = ~crossed & ~whole
            live, a, b, from_right = live[on], a[on], b[on], from_right[on]
            limit = np.where(from_right, ranks_b[on] + 0, ranks_a[on])
            # The touching pair, were it to merge at the same rank as the left piece's own merge, would do so later.
            limit = np.where(from_right, limit + 1, limit)
            next_a, next_b = np.where(from_right, a, self.right[a]), np.where(from_right, self.left[b], b)
            a, b = next_a, next_b
        return out


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, sorted by their first ``depth`` characters, by doubling."""
    # Start with as many characters as fit into one number.
    bits, width = int(codes.max(initial=1)).bit_length(), 1
    keys = codes.astype(np.int64)
    while 2 * width * bits <= 62 and width < depth:
        keys, width = (keys << (width * bits)) | _ahead(keys, width), 2 * width
    order, rank = _ranked(keys)
    while width < depth:
        order, rank = _ranked(rank * (len(codes) + 1) + _ahead(rank, width))
        width *= 2
    return order


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[:-by] = values[by:]
    return out


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and from 1 the rank of each among the distinct ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    rank = np.empty_like(keys)
    rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) + 1
    return order, rank


class Encoder:
    """Ids of texts, as the model's own encoder gives them for texts it does not normalise."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        v = self.v
        by_char = sorted(v.ids)
        alphabet = sorted({c for piece in by_char for c in piece})
        #: Character codes from 2 in code point order; 0 ends a unit, 1 is none of the vocabulary.
        self.code = {c: i + 2 for i, c in enumerate(alphabet)}
        self.width = v.longest
        self.piece_ids = np.array([v.ids[piece] for piece in by_char])
        self.piece_sizes = np.array([len(piece) for piece in by_char])
        self.matrix = np.zeros((len(by_char), self.width), dtype=np.int32)
        for row, piece in zip(self.matrix, by_char):
            row[: len(piece)] = [self.code[c] for c in piece]
        self.memo_keys, self.memo = np.full(MEMO, -1, dtype=np.int64), np.zeros(MEMO, dtype=bool)
        self.known = Memory(REMEMBERED)

    def _ranges(self, codes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in ``order`` of the suffixes that begin with each piece, by binary search."""
        padded = np.concatenate([codes, np.zeros(self.width, dtype=codes.dtype)])
        bounds = []
        for upper in (False, True):
            low, high = np.zeros(len(self.matrix), dtype=np.int64), np.full(len(self.matrix), len(order), dtype=np.int64)
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                sizes = self.piece_sizes[open_]
                start, state = order[middle], np.zeros(len(open_), dtype=np.int8)
                undecided = np.arange(len(open_))
                for k in range(self.width):
                    undecided = undecided[(sizes[undecided] > k)]
                    if not len(undecided):
                        break
                    a, b = padded[start[undecided] + k], self.matrix[open_[undecided], k]
                    state[undecided] = np.sign(a.astype(np.int64) - b)
                    undecided = undecided[a == b]
                # state: how the suffix compares with the piece, 0 if it begins with it
                left = (state < 0) | ((state == 0) & upper)
                low[open_[left]], high[open_[~left]] = middle[left] + 1, middle[~left]
            bounds.append(low)
        return bounds[0], bounds[1]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a << 20) | b
        slot = ((keys * 0x9E3779B1) >> 11) & (MEMO - 1)
        out, new = self.memo[slot], np.flatnonzero(self.memo_keys[slot] != keys)
        if len(new):
            found = self.v.apart(a[new], b[new])
            out[new] = found
            self.memo_keys[slot[new]], self.memo[slot[new]] = keys[new], found
        return out

    def _match(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units, matched together, as little-endian numbers of 4 bytes."""
        v, text = self.v, "\0".join(units) + "\0"
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        distinct, inverse = np.unique(points, return_inverse=True)
        codes = np.array([self.code.get(chr(p), 1) for p in distinct], dtype=np.int32)[inverse]
        ends = starts + sizes
        codes[ends] = 0
        order = suffix_array(codes, self.width)
        low, high = self._ranges(codes, order)
        counts = high - low
        pieces = np.repeat(np.arange(len(low)), counts)
        offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = order[np.repeat(low, counts) + offsets]
        ids, stop = self.piece_ids[pieces], begin + self.piece_sizes[pieces]
        # A character of no piece is an edge of its own, told by the vocabulary's unknown id.
        strange = np.flatnonzero(codes == 1)
        begin, stop = np.concatenate([begin, strange]), np.concatenate([stop, strange + 1])
        ids = np.concatenate([ids, np.full(len(strange), v.unknown)])
        unit_of = np.repeat(np.arange(len(units)), sizes + 1)
        # Edges by place of their end within the unit: all units advance together.
        local = stop - starts[unit_of[begin]]
        small = len(local) and int(local.max()) < 1 << 15
        by_end = np.argsort(local.astype(np.int16) if small else local, kind="stable")
        begin, stop, ids, local = begin[by_end], stop[by_end], ids[by_end], local[by_end]
        last, back = np.full(len(codes), -1, dtype=np.int64), np.full(len(codes), -1, dtype=np.int64)
        first = np.zeros(len(codes), dtype=bool)
        first[starts] = True
        steps = np.flatnonzero(np.diff(local, prepend=-1, append=-1))
        for a, b in zip(steps, steps[1:]):
            at, to, piece = begin[a:b], stop[a:b], ids[a:b]
            before = last[at]
            good = first[at].copy()
            inner = np.flatnonzero(~good & (before >= 0))
            odd = (before[inner] == v.unknown) | (piece[inner] == v.unknown)
            good[inner[odd]] = True
            plain = inner[~odd]
            if len(plain):
                good[plain] = self._apart(before[plain], piece[plain])
            last[to[good]], back[to[good]] = piece[good], at[good]
        out, place = [b""] * len(units), ends.copy()
        # Walk back from all ends at once.
        owner = np.arange(len(units))
        found_owner, found_id, found_at = [], [], []
        while len(owner):
            if (last[place] < 0).any():
                raise ValueError("a unit has no encoding")
            found_owner.append(owner)
            found_id.append(last[place])
            found_at.append(back[place])
            place = back[place]
            going = place > starts[owner]
            owner, place = owner[going], place[going]
        owner, found, at = map(np.concatenate, (found_owner, found_id, found_at))
        sort = np.argsort(at, kind="stable")
        owner, found, at = owner[sort], found[sort], at[sort]
        bounds = np.searchsorted(owner, np.arange(len(units) + 1))
        if len(strange) and v.bytes:
            for i in set(owner[found == v.unknown].tolist()):
                out[i] = self._with_bytes(found[bounds[i] : bounds[i + 1]], text, at[bounds[i] : bounds[i + 1]])
        flat, cuts = found.astype("<i4").tobytes(), (4 * bounds).tolist()
        return [x or flat[a:b] for x, a, b in zip(out, cuts, cuts[1:])]

    def _with_bytes(self, ids: np.ndarray, text: str, at: np.ndarray) -> bytes:
        parts = [[self.v.bytes[b] for b in text[place].encode()] if i == self.v.unknown else [i] for i, place in zip(ids.tolist(), at.tolist())]
        return np.array([x for part in parts for x in part], dtype="<i4").tobytes()

    def units(self, text: str) -> list[str]:
        """Parts of a text that no piece crosses."""
        found = UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []
        if not any(len(unit) >= LONG_UNIT for unit in found):
            return found
        return [part for unit in found for part in (self._cut(unit) if len(unit) >= LONG_UNIT else [unit])]

    def _cut(self, unit: str) -> list[str]:
        points = np.frombuffer(unit.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        pairs, inner = (points[:-1] << 21) | points[1:], self.v.inner
        joined = inner[np.minimum(np.searchsorted(inner, pairs), len(inner) - 1)] == pairs
        cuts = [0, *(np.flatnonzero(~joined) + 1).tolist(), len(unit)]
        return [unit[a:b] for a, b in zip(cuts, cuts[1:])]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.units(text) for text in texts]
        new = self.known.missing(set().union(*cut))
        some, size = [], 0
        for i, unit in enumerate(new):
            some.append(unit)
            size += len(unit) + 1
            if size >= INDEXED or i == len(new) - 1:
                self.known.put(some, self._match(some))
                some, size = [], 0
        return [np.frombuffer(b"".join(map(self.known.young.__getitem__, units)), dtype="<i4") for units in cut]


class Decoder:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.parts = [self._part(model, i) for i in range(model.get_piece_size())]

    @staticmethod
    def _part(model, i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(SPACE, " ").encode()

    def __call__(self, ids: list[int]) -> str:
        """The text; the space put before it when encoding is taken off again."""
        return b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _groups(batch: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch, ``CHARACTERS`` together at a time."""
    some, size = [], 0
    for text in batch:
        some.append(text.as_py())
        size += len(some[-1] or "")
        if size >= CHARACTERS:
            yield some
            some, size = [], 0
    if some:
        yield some


def _lists(ids: list[np.ndarray], missing: list[bool]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate([np.empty(0, dtype=np.int32), *ids])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()), mask=pa.array(missing, pa.bool_()))


def _joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _new(docs: DataFrame, *names: str) -> DataFrame:
    """``docs``, unless it has one of the columns that are to be added."""
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"there is a column {', '.join(sorted(clash))} already")
    return workers_know(docs)


def encoded(docs: DataFrame, model: str, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the ids of its text. Null gives null, an empty text no ids; ``name`` must be a new column.

    Texts are matched in each task's own batches, so memory is that of a batch and of the
    bytes of units remembered; no shuffle, no broadcast but the path of the model. A long text is
    one step of its batch; repeated rows are encoded alike; an empty table gives no row.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = kept(("pieces", model), lambda: Encoder(model))
        for batch in batches:
            parts = [_lists(of([x or "" for x in texts]), [x is None for x in texts]) for texts in _groups(batch)]
            yield _joined(parts, pa.list_(pa.int32()))

    return _new(docs, name).withColumn(name, encode(F.col(f"`{text}`")))


def decoded(rows: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text that the ids stand for. Null gives null; ``name`` must be a new column."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = kept(("parts", model), lambda: Decoder(model))
        for batch in batches:
            yield pa.array([None if not x.is_valid else of(x.values.to_numpy().tolist()) for x in batch], pa.string())

    return _new(rows, name).withColumn(name, decode(F.col(f"`{ids}`")))


def round_trips(docs: DataFrame, model: str, text: str = "text", names: tuple[str, str] = ("ids", "decoded")) -> DataFrame:
    """``docs`` with the ids of its text and the text decoded from them, as :func:`encoded` and :func:`decoded` in one task."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, decode = kept(("pieces", model), lambda: Encoder(model)), kept(("parts", model), lambda: Decoder(model))
        for batch in batches:
            lists, back = [], []
            for texts in _groups(batch):
                ids = encode([x or "" for x in texts])
                lists.append(_lists(ids, [x is None for x in texts]))
                back.append(pa.array([None if x is None else decode(y.tolist()) for x, y in zip(texts, ids)], pa.string()))
            yield pa.StructArray.from_arrays([_joined(lists, pa.list_(pa.int32())), _joined(back, pa.string())], ["ids", "decoded"])

    found = _new(docs, *names).select("*", both(F.col(f"`{text}`")).alias("_both"))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_both.ids").alias(names[0]), F.col("_both.decoded").alias(names[1]))
