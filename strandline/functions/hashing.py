"""Row hashes that tell whether a row has changed."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .values import nfc

#: What stands for missing and special values, and between columns.
_MARK = "\x1f"
NULL, NAN, INF, NEG_INF = (f"{_MARK}{x}{_MARK}" for x in ("NULL", "NaN", "INF", "-INF"))


def hash_text(col: Column, kind: T.DataType, *, empty_as_null: bool = False, portable: bool = False) -> Column:
    """The text that a column adds to the hash; never null.

    Strings are NFC without trailing spaces.  Doubles are rounded first and then have their negative
    zero folded: ten decimals as text, or, if ``portable``, four as a scaled integer, which other
    engines print alike.
    """
    if isinstance(kind, T.StringType):
        value = F.when(col == "", None).otherwise(col) if empty_as_null else col
        value = F.rtrim(nfc(value))
    elif isinstance(kind, T.BinaryType):
        value = F.lower(F.hex(col))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        x = col.cast("double")
        if portable:
            plain = F.round(x * 10_000).cast("bigint").cast("string")
        else:
            plain = F.format_string("%.10f", F.round(x, 10) + F.lit(0.0))
        value = (
            F.when(F.isnan(x), F.lit(NAN))
            .when(x == float("inf"), F.lit(INF))
            .when(x == float("-inf"), F.lit(NEG_INF))
            .otherwise(plain)
        )
    elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        value = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.BooleanType):
        value = col.cast("int").cast("string")
    else:
        value = col.cast("string")
    return F.coalesce(value, F.lit(NULL))


def hashed_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns that count: none that begins with an underscore or is excluded; unknown names give a warning."""
    left_out = set(exclude)
    if unknown := sorted(left_out - set(df.columns)):
        warnings.warn(f"no such columns to leave out of the hash: {', '.join(unknown)}", stacklevel=3)
    return [c for c in df.columns if not c.startswith("_") and c not in left_out]


def rewrite_strings(df: DataFrame, *, empty_as_null: bool = False) -> DataFrame:
    """``df`` with its strings stored as they are hashed: NFC without trailing spaces, '' as null if asked."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and not f.name.startswith("_"):
            col = F.col(f"`{f.name}`")
            out[f.name] = F.rtrim(nfc(F.when(col == "", None).otherwise(col) if empty_as_null else col))
    return df.withColumns(out) if out else df


def row_hash(df: DataFrame, exclude: Iterable[str] = (), *, empty_as_null: bool = False, portable: bool = False) -> Column:
    """SHA-256 of the row's columns in their order, as 64 hex digits."""
    texts = [
        hash_text(F.col(f"`{c}`"), df.schema[c].dataType, empty_as_null=empty_as_null, portable=portable)
        for c in hashed_columns(df, exclude)
    ]
    return F.sha2(F.concat_ws(_MARK, *texts) if texts else F.lit(""), 256)


def add_row_hash(df: DataFrame, exclude: Iterable[str] = (), *, name: str = "_row_hash", **how: bool) -> DataFrame:
    """``df`` with its row hash."""
    return df.withColumn(name, row_hash(df, exclude, **how))
