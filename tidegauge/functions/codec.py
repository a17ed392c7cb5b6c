"""Typed JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECT = "_unreadable"


def decode_json(value: Column, schema: StructType, strict: bool = False) -> Column:
    """JSON text as a struct of the declared type.

    Missing fields are null. Text that cannot be read is kept in the extra
    field ``_unreadable``; with ``strict`` it fails the query instead.
    """
    if strict:
        return F.from_json(value, schema, {"mode": "FAILFAST"})
    widened = StructType([*schema.fields, StructField(REJECT, StringType())])
    return F.from_json(value, widened, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT})


def quarantine(df: DataFrame, decoded: str) -> tuple[DataFrame, DataFrame]:
    """Split rows by whether the struct column ``decoded`` could be read.

    Both results are filters over the same input, for two writes of one batch.
    """
    bad = F.col(decoded).isNull() | F.col(f"{decoded}.{REJECT}").isNotNull()
    good = df.filter(~bad).withColumn(decoded, F.col(decoded).dropFields(REJECT))
    return good, df.filter(bad)


def encode_json(*columns: Column | str) -> Column:
    """The given columns as one JSON object per row."""
    return F.to_json(F.struct(*columns))
