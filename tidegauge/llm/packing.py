"""Concatenate and cut: all documents as one token stream, cut every ``window`` tokens.

Pass 1 turns every document into ids and notes, per task, where in the task's own
stream each document starts. The tasks' totals are then summed up into the task's
place in the whole stream. Pass 2 adds that place and cuts; a document that
crosses a cut gives one boundary record, here called a piece, on either side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, settle, workers_know

WINDOW, END_ID, ID_BYTES = 2048, 1, 4
#: Fixed values of byte-level vocabularies: how text is cut, and the byte that a character stands for.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_OF = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*SHOWN}))}
#: White space as ``WORDS`` knows it. Runs from ``LONG_RUN`` characters are cut off here, since matching them takes a stack as long as they are.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONG_RUN = 100_000
TOKENS = "doc_id long, part int, within long, n long, ids binary"


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    They are those of the tokenizer in the file ``path``, a byte-level vocabulary whose ids
    are the ranks of its merges. Its merging is done by ``tiktoken``, which takes less
    than half the time. Text is split at the file's added tokens first, which get their ids;
    with ``escape`` they are ordinary text, so that a document cannot write a control token.
    """

    def __init__(self, path: str, escape: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
        ranks = {bytes(map(BYTE_OF.__getitem__, name)): i for name, i in tokenizer.get_vocab().items() if name not in added}
        self.encoding = tiktoken.Encoding("from file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={} if escape else added)

    def __call__(self, text: str) -> bytes:
        if len(text) < LONG_RUN:
            return self._plain(text)
        out, at = [], 0
        for start, end in (run.span() for run in SPACES.finditer(text)):
            if end - start >= LONG_RUN:
                end -= end < len(text)  # ``\s+(?!\S)`` leaves the last one to what follows
                ids = self.encoding._encode_single_piece(text[start:end])
                out += [self._plain(text[at:start]), np.array(ids, dtype="<u4").tobytes()]
                at = end
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False).tobytes()


def tokenised(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", escape: bool = False) -> DataFrame:
    """One row per document with its ids, the end id included, written to the shared folder.

    ``within`` counts the tokens of the same task before the document. A task
    that runs again writes all of its rows again, so they always fit together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(("ids", vocabulary, escape), lambda: Encoder(vocabulary, escape))
        part, within = TaskContext.get().partitionId(), 0
        end = END_ID.to_bytes(ID_BYTES, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [encode(x.as_py() or "") + end for x in some.column(1)]
                starts = []
                for x in ids:
                    starts.append(within)
                    within += len(x) // ID_BYTES
                n = [len(x) // ID_BYTES for x in ids]
                columns = [some.column(0), pa.array([part] * len(n), pa.int32()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "within", "n", "ids"])

    rows = workers_know(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return settle(rows.mapInArrow(run, TOKENS), "tokens")


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", escape: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset.

    Every sequence but the last is full. A null text counts as empty and gives
    the end id alone; equal rows are packed as often as they occur; an empty
    table gives no row; other columns are ignored. Pieces of a sequence follow
    each other without a gap. The list of tasks is the one thing broadcast: a
    number per task of pass 1, whatever the documents. Added tokens of the vocabulary that
    stand in a text get their ids; ``escape`` makes them ordinary text.
    """
    tokens = tokenised(docs, vocabulary, doc_id, text, escape)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("within"))
    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("n") - 1) / window)

    def piece(sequence):
        start = F.greatest(F.lit(0), sequence * window - F.col("at"))
        length = F.least(F.col("n"), (sequence + 1) * window - F.col("at")) - start
        ids = F.substring(F.col("ids"), (start * ID_BYTES + 1).cast("int"), (length * ID_BYTES).cast("int"))
        return F.struct(
            start.alias("start"),
            length.alias("length"),
            ids.alias("ids"),
            F.crc32(ids).alias("ids_crc32"),
            F.col("n").alias("doc_tokens"),
            sequence.alias("sequence_id"),
            (F.col("at") + start - sequence * window).alias("offset"),
        )

    return placed.select("doc_id", F.inline(F.transform(F.sequence(first, last), piece)))


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed sequences: sequence_id, ids (``window`` numbers of 4 bytes, padded), tokens.

    A group is one sequence, at most ``window`` pieces.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, x: F.concat(out, x["ids"]))
    rows = pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("tokens"))
    pad = F.lit(pad_id.to_bytes(ID_BYTES, "little"))
    return rows.withColumn("ids", F.rpad(F.col("ids"), F.lit(window * ID_BYTES), pad))
