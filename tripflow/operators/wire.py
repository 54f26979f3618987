"""Wire records: rows ⇄ one JSON object per message in a binary payload.

Encoding and decoding are single projections with built-in JSON functions
(``to_json`` / ``from_json``), the same for batch and streaming DataFrames; no
Python touches a record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow import schema as S

CORRUPT = "_corrupt_record"

# Payload column per source kind.
PAYLOAD_COLUMN = {"kafka": "value", "aws-kinesis": "data", "kinesis": "data", "file": "value"}


def to_wire(
    df: DataFrame,
    payload_col: str = "value",
    key_cols: list[str] | None = None,
    columns: list[str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows → JSON payload bytes (K9, E13); optional text ``key``.

    Null fields are written as ``null`` so every message carries every key.
    The key is the key columns' text; where a key column is absent or null it
    falls back to a hash of the whole row, so keys spread evenly. ``columns``
    selects the encoded fields (default: all); ``keep`` passes columns through.
    """
    fields = columns or [c for c in df.columns if c not in keep]
    payload = F.to_json(F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"}).cast("binary")
    out = [*keep, payload.alias(payload_col)]
    if key_cols is not None:
        fallback = F.xxhash64(*[F.col(c) for c in fields]).cast("string")
        present = [c for c in key_cols if c in fields]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in present]) if present else None
        if present:
            all_null = None
            for c in present:
                all_null = F.col(c).isNull() if all_null is None else (all_null & F.col(c).isNull())
            key = F.when(all_null, fallback).otherwise(key)
        else:
            key = fallback
        out.append(key.alias("key"))
    return df.select(*out)


def payload_text(payload_col: str = "value"):
    """Payload bytes → UTF-8 text."""
    return F.col(payload_col).cast("string")


def from_wire(df: DataFrame, payload_col: str = "value", schema: StructType = S.TRIP, keep_corrupt: bool = False) -> DataFrame:
    """Payload → typed, flat columns by a fixed schema (P1–P3, PERMISSIVE).

    A malformed payload yields an all-null row; a field of the wrong type nulls
    only that field. With ``keep_corrupt`` the raw text of such records is kept
    in ``_corrupt_record`` (null payloads stay null there).
    """
    parse_schema = StructType(schema.fields + [StructField(CORRUPT, StringType())]) if keep_corrupt else schema
    options = {"mode": "PERMISSIVE"}
    if keep_corrupt:
        options["columnNameOfCorruptRecord"] = CORRUPT
    parsed = df.select(F.from_json(payload_text(payload_col), parse_schema, options).alias("data"))
    return parsed.select("data.*")


def decode_flagged(df: DataFrame, payload_col: str = "value", schema: StructType = S.TRIP) -> DataFrame:
    """Decoded rows plus ``is_malformed``: null payload, or text not parsable."""
    parsed = df.select(
        F.from_json(payload_text(payload_col), StructType(schema.fields + [StructField(CORRUPT, StringType())]), {"columnNameOfCorruptRecord": CORRUPT}).alias("data"),
        F.col(payload_col).isNull().alias("_null_payload"),
    )
    return parsed.select(
        *[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields],
        (F.col("_null_payload") | F.col(f"data.{CORRUPT}").isNotNull()).alias("is_malformed"),
    )


def split_malformed(decoded_flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, malformed) from ``decode_flagged`` output."""
    return (
        decoded_flagged.filter(~F.col("is_malformed")).drop("is_malformed"),
        decoded_flagged.filter(F.col("is_malformed")).drop("is_malformed"),
    )


def conform(df: DataFrame, schema: StructType = S.TRIP, strict: bool = False) -> DataFrame:
    """Columns in schema order and type.

    ``strict`` uses ``DataFrame.to``: an unsafe type change (e.g. text to
    double) fails instead of casting; a missing nullable column reads null.
    """
    if strict:
        return df.to(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
