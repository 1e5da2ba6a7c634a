"""Rows and schemas made fit for comparison: keys, repeats, control characters, types.

Every function takes and returns DataFrames lazily; empty tables stay empty, nulls are kept unless a
function says otherwise, and columns that aren't named are carried through.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BLANK = "<BLANK>"
#: Characters that a delimited bulk file can't hold.
CONTROL = "[\\t\\n\\r\\x00\\x0B\\x0C\\u0085\\u2028\\u2029]"
#: What a log line must not show.
SECRETS = (
    # What precedes the word stays as it is, so it needn't be matched: that would try every start in every word.
    (r"(?i)(password)\s*[=:]\s*\S+", "$1=***"),
    (r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----", "***"),
    (r"(?i)passphrase\s*[=:]\s*\S+", "passphrase=***"),
)


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def coerce_blank_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Blank string keys become ``<BLANK>``, so they can be joined; null keys stay null."""
    return df.withColumns({k: F.when(F.trim(k) == "", F.lit(BLANK)).otherwise(F.col(k)) for k in keys if k in _strings(df)})


def _whole(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no null part."""
    return df.where(_whole(keys))


def null_key_report(df: DataFrame, keys: Sequence[str], error_above: float = 0.01) -> DataFrame:
    """(total_rows, null_key_rows, level): ERROR if their share is above the limit, else WARN or OK."""
    counts = df.agg(F.count("*").alias("total_rows"), F.count_if(~_whole(keys)).alias("null_key_rows"))
    level = F.when(F.col("null_key_rows") == 0, "OK").when(F.col("null_key_rows") > F.col("total_rows") * error_above, "ERROR")
    return counts.withColumn("level", level.otherwise("WARN"))


def one_row(*frames: DataFrame) -> DataFrame:
    """The columns of several one-row frames in one row."""
    names = [c for f in frames for c in f.columns]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).agg(*[F.max(c).alias(c) for c in names])


def union_of_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """(keys) that any of the frames has, once each; repeats are dropped before the shuffle."""
    return reduce(DataFrame.unionByName, [f.select(*keys) for f in frames]).distinct()


def key_literal(keys: Sequence[str], between: str = "|") -> Column:
    """A key as one text, for samples and messages; null parts are empty."""
    return F.concat_ws(between, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def parse_order(spec: str | None) -> list[tuple[str, bool]]:
    """``"a, b ASC"`` as [(column, ascending)]; the default is descending."""
    out = []
    for part in (spec or "").split(","):
        words = part.split()
        if not words:
            continue
        if len(words) > 2 or (len(words) == 2 and words[1].upper() not in ("ASC", "DESC")):
            raise ValueError(f"can't read the order {part!r}")
        out.append((words[0], len(words) == 2 and words[1].upper() == "ASC"))
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``.  The window's rank limit is pushed below the shuffle,
    so a hot key sends one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedup_by_order(df: DataFrame, keys: Sequence[str], spec: str | None) -> DataFrame:
    """One row per key by a configured order, nulls last; all columns break ties, so it can be repeated."""
    named = [(F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last()) for c, up in parse_order(spec)]
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    return keep_first(df, keys, [*named, *rest])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row and how many: (keys, n)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def key_uniqueness(df: DataFrame, keys: Sequence[str], top: int = 5) -> DataFrame:
    """The most repeated keys, ties by key."""
    return duplicate_keys(df, keys).orderBy(F.desc("n"), *keys).limit(top)


def sanitize_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Strings without control characters and line ends."""
    return df.withColumns({c: F.regexp_replace(c, CONTROL, "") for c in (columns or _strings(df))})


def unsanitized(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per string column, how many values still hold such characters: (column_name, bad_values)."""
    names = list(columns or _strings(df))
    counts = df.agg(*[F.count_if(F.col(c).rlike(CONTROL)).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "bad_values")


def redact(col: Column) -> Column:
    """Text without passwords, private keys and passphrases."""
    for pattern, by in SECRETS:
        col = F.regexp_replace(col, pattern, by)
    return col


def bits_to_tinyint(df: DataFrame) -> DataFrame:
    """Booleans as 0 and 1."""
    return df.withColumns({f.name: F.col(f.name).cast("tinyint") for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)})


def parse_times(col: Column, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def looks_like_times(df: DataFrame, column: str, share: float = 0.9) -> DataFrame:
    """(parsed, filled, is_time) of a string column over all its values."""
    ok = parse_times(F.col(column)).isNotNull()
    counts = df.agg(F.count_if(ok).alias("parsed"), F.count(column).alias("filled"))
    return counts.withColumn("is_time", (F.col("filled") > 0) & (F.col("parsed") >= F.col("filled") * share))


def blank_far_dates(df: DataFrame, columns: Sequence[str], limit: str = "9999-01-01") -> DataFrame:
    """Dates at or after the limit become null."""
    return df.withColumns({c: F.when(F.col(c) < F.lit(limit).cast("date"), F.col(c)) for c in columns})


def add_extracted_at(df: DataFrame, at: str, name: str = "_extracted_at") -> DataFrame:
    """``df`` with the time of its extraction, the same for all rows."""
    return df.withColumn(name, F.lit(at).cast("timestamp_ntz"))


def add_cdc_columns(df: DataFrame, operation: str | Column, valid_from: str, batch_id: int) -> DataFrame:
    """``df`` with the change log's columns, open and current."""
    op = F.lit(operation) if isinstance(operation, str) else operation
    return df.withColumns(
        {
            "_cdc_operation": op,
            "_cdc_valid_from": F.lit(valid_from).cast("timestamp_ntz"),
            "_cdc_valid_to": F.lit(None).cast("timestamp_ntz"),
            "_cdc_is_current": F.lit(1).cast("tinyint"),
            "_cdc_batch_id": F.lit(batch_id).cast("bigint"),
        }
    )


def _typed(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: values that don't fit and missing columns are null."""
    return df.select(*[_typed(df, f) for f in schema.fields])


def contract(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns that are missing and columns that weren't expected; internal ones don't count."""
    have = [c for c in df.columns if not c.startswith("_")]
    return [c for c in expected if c not in have], [c for c in have if c not in expected]


def reorder(df: DataFrame, target: Sequence[str], fill: Sequence[str] = (), kinds: T.StructType | None = None) -> DataFrame:
    """The target's columns in its order; those in ``fill`` may be missing and are null then, of the type
    that ``kinds`` gives, else text."""
    missing = [c for c in target if c not in df.columns and c not in fill]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    kind = {f.name: f.dataType for f in (kinds or [])}
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kind.get(c, T.StringType())).alias(c) for c in target])


_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type in which columns of these types can be united: bool below int below double; a zone
    wins among times; anything else is text.  A column that is null throughout takes the others' type."""
    kinds = [k for k in kinds if not isinstance(k, T.NullType)] or [T.StringType()]
    if len({k.simpleString() for k in kinds}) == 1:
        return kinds[0]
    is_int = [type(k) in _RANK for k in kinds]
    is_bool = [isinstance(k, T.BooleanType) for k in kinds]
    is_float = [isinstance(k, (T.DoubleType, T.FloatType)) for k in kinds]
    is_time = [isinstance(k, (T.TimestampType, T.TimestampNTZType)) for k in kinds]
    if all(i or b for i, b in zip(is_int, is_bool, strict=True)):
        return max((k for k in kinds if type(k) in _RANK), key=lambda k: _RANK[type(k)])
    if all(i or b or f for i, b, f in zip(is_int, is_bool, is_float, strict=True)):
        return T.DoubleType()
    if all(is_time):
        return T.TimestampType()
    return T.StringType()


def safe_concat(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name, in common types; missing columns are null."""
    names = list(dict.fromkeys(c for f in frames for c in f.columns))
    kinds = [T.StructField(n, common_type([f.schema[n].dataType for f in frames if n in f.columns])) for n in names]
    return reduce(DataFrame.unionByName, [conform(f, T.StructType(kinds)) for f in frames])


def strict_union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames that have the very same columns and types; raises otherwise."""
    first = [(f.name, f.dataType) for f in frames[0].schema.fields]
    for other in frames[1:]:
        if [(f.name, f.dataType) for f in other.schema.fields] != first:
            raise ValueError(f"schemas differ: {frames[0].schema.simpleString()} and {other.schema.simpleString()}")
    return reduce(DataFrame.union, frames)


def null_inflation(before: DataFrame, after: DataFrame, keys: Sequence[str], limit: float = 0.01) -> DataFrame:
    """(column_name, before_rate, after_rate, inflated): columns whose nulls grew; keys may not at all."""
    names = [c for c in before.columns if c in after.columns]

    def rates(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names]).unpivot([], names, "column_name", name)

    both = rates(before, "before_rate").join(rates(after, "after_rate"), "column_name")
    allowed = F.when(F.col("column_name").isin(list(keys)), 0.0).otherwise(limit)
    return both.withColumn("inflated", F.coalesce(F.col("after_rate") - F.col("before_rate") > allowed, F.lit(False)))


def align_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with keys of one type: the wider number, else text."""
    casts = {k: common_type([a.schema[k].dataType, b.schema[k].dataType]) for k in keys}
    return tuple(x.withColumns({k: F.col(k).cast(t) for k, t in casts.items()}) for x in (a, b))


def rename_candidates(removed: DataFrame, added: DataFrame, within: int = 3) -> DataFrame:
    """(old_name, new_name, distance): columns of one type whose names are close.

    Both inputs are lists of a table's columns (name, type), matched by type.
    """
    pairs = removed.select(F.col("name").alias("old_name"), "type").join(added.select(F.col("name").alias("new_name"), "type"), "type")
    d = F.levenshtein(F.lower("old_name"), F.lower("new_name"))
    return pairs.select("old_name", "new_name", d.alias("distance")).where(F.col("distance") <= within)


def token(col: Column, key: str, pii_type: str) -> Column:
    """The same token for the same value: null stays null, '' has a token too."""
    return F.sha2(F.concat(F.lit(f"{key}|{pii_type}|"), col), 256)


def token_map(df: DataFrame, columns: Sequence[str], key: str, pii_type: str) -> DataFrame:
    """(token, plaintext) of all distinct values, for detokenising."""
    values = reduce(DataFrame.union, [df.select(F.col(c).cast("string").alias("plaintext")) for c in columns])
    return values.where("plaintext IS NOT NULL").distinct().select(token(F.col("plaintext"), key, pii_type).alias("token"), "plaintext")


def tokenise(df: DataFrame, columns: Sequence[str], key: str, pii_type: str) -> DataFrame:
    """Values replaced by their tokens."""
    return df.withColumns({c: token(F.col(c).cast("string"), key, pii_type) for c in columns})


def token_use(before: DataFrame, now: DataFrame) -> DataFrame:
    """One row: tokens of ``now`` that the map ``before`` has already, and new ones."""
    seen = before.select("token").distinct().withColumn("__s", F.lit(True))
    both = now.select("token").where("token IS NOT NULL").distinct().join(seen, "token", "left")
    return both.agg(F.count_if(F.col("__s").isNotNull()).alias("reused"), F.count_if(F.col("__s").isNull()).alias("new"))


def detokenise(df: DataFrame, column: str, tokens: DataFrame, status: Sequence[str] = ()) -> DataFrame:
    """Tokens replaced by their plain text where it is known, and, if states are given, only where the token is in one; others become null."""
    tokens = tokens.where(F.col("Status").isin(*status)) if status else tokens
    known = tokens.select(F.col("token").alias("__t"), F.col("plaintext").alias("__p"))
    return df.join(known, F.col(column) == F.col("__t"), "left").withColumn(column, F.col("__p")).drop("__t", "__p")


def identifier(name: str) -> str:
    """A file's column name as a plain identifier."""
    return re.sub(r"\W+", "_", name.strip()).strip("_")
