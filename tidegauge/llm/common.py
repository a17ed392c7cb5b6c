"""What several operators share: tables in the shared folder, packed rows, lower-casing."""

from __future__ import annotations

import re
import sys
from types import ModuleType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_folder, ship_package

#: Words end at ASCII white space only.
SPACED = re.compile(r"[^ \t-\r]+")
#: Lower-cases A-Z in UTF-8 and leaves every other byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """``df``, written once to the folder of ``spark.checkpoint.dir`` and read again.

    Like a checkpoint it cuts the lineage and outlives executors, but it is
    columnar and compressed. It stays there as checkpoints do.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def workers_know(df: DataFrame) -> DataFrame:
    """Makes sure that Python workers can load this package's functions."""
    ship_package(df.sparkSession)
    return df


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, so that none clashes with a column of ours."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty.

    ``lower`` does just that on pure ASCII and is much the faster of the two.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER_CASE, LOWER_CASE))


def kept(key, make):
    """``make()``, once for all tasks of a Python worker. Functions travel by value, so this package cannot hold it."""
    stash = sys.modules.setdefault("_tidegauge_kept", ModuleType("_tidegauge_kept")).__dict__
    if key not in stash:
        stash[key] = make()
    return stash[key]


class Memory:
    """What a worker remembers of words: the last ones met, of ``size`` bytes to twice as many.

    When the young half is full, it becomes the old one; what is met again moves back.
    """

    #: Bytes of an entry beside those of the word and its value.
    ENTRY = 200

    def __init__(self, size: int):
        self.size, self.held, self.young, self.old = size, 0, {}, {}

    def put(self, words, values) -> None:
        for word, value in zip(words, values):
            self.young[word] = value
            self.held += self.ENTRY + 2 * len(word) + len(value)

    def missing(self, words) -> list:
        """Those of ``words`` that are not remembered. All others are in ``young`` afterwards."""
        if self.held > self.size:
            self.young, self.old, self.held = {}, self.young, 0
        new = [word for word in words if word not in self.young]
        if self.old:
            found = [word for word in new if word in self.old]
            self.put(found, map(self.old.__getitem__, found))
            new = [word for word in new if word not in self.old]
        return new
