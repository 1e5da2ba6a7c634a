"""Value equality across copies of a table.

Two strings are equal when they match after composing Unicode (NFC) and dropping trailing spaces
(U+0020 only); two doubles when they differ by less than ``EPSILON``; NaN equals NaN, 0 equals -0,
and null equals only null.  Everything here is a JVM expression, so scans stay inside codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

EPSILON = 1e-6
#: Beyond this magnitude neighbouring doubles are further apart than EPSILON.
_EXACT_FROM = 9.0e9


def nfc(col: Column) -> Column:
    """NFC of a string column; null stays null.

    Strings made only of characters below U+0300 are composed already and skip the call.
    """
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(False))
    return F.when(col.rlike(r"[^\x{0}-\x{2ff}]"), composed).otherwise(col)


def canonical_string(col: Column) -> Column:
    """NFC without trailing spaces: equal strings have the same canonical form."""
    return F.rtrim(nfc(col))


def double_cell(col: Column) -> Column:
    """A text that is the same only for doubles closer than EPSILON (grid cells one EPSILON wide).

    Equal values can fall into neighbouring cells, so a differing cell is only a candidate;
    :func:`same` decides.
    """
    x = col.cast("double")
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(F.abs(x) < _EXACT_FROM, F.round(x / EPSILON).cast("bigint").cast("string"))
        .otherwise((x + F.lit(0.0)).cast("string"))
    )


def same(a: Column, b: Column, kind: T.DataType) -> Column:
    """Never-null equality; strings must be canonical already."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        near = F.when(F.isnan(a) | F.isnan(b), F.isnan(a) & F.isnan(b)).otherwise(
            (a == b) | (F.abs(a - b) < F.lit(EPSILON))
        )
        return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)
    return a.eqNullSafe(b)


def value_hash(cols: Iterable[tuple[Column, T.DataType]]) -> Column:
    """64-bit hash of canonical values; null differs from every value, and positions count."""
    parts: list[Column] = []
    for col, kind in cols:
        parts.append(F.when(col.isNull(), F.lit(1)).otherwise(F.lit(0)))
        parts.append(double_cell(col) if isinstance(kind, (T.DoubleType, T.FloatType)) else col)
    return F.xxhash64(*parts)


def field_types(df, names: Iterable[str]) -> dict[str, T.DataType]:
    """Types by column name."""
    return {n: df.schema[n].dataType for n in names}


def canonical(df, names: Iterable[str]):
    """``df`` with the strings among ``names`` in canonical form."""
    kinds = field_types(df, names)
    return df.withColumns({n: canonical_string(F.col(f"`{n}`")) for n, k in kinds.items() if isinstance(k, T.StringType)})
