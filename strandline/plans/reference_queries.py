"""Queries that run every operator over the test tables, each beside the SQL that gives the same rows.

Fixtures are derived from the tables without chance or clock: two versions of the orders, a history
of customers over three loads, states of users from events, and the account, person and pipeline
tables as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import add_row_hash, row_hash
from ..operators import cdc, cleaning, integrity, profiling, reads, reconcile, scd2
from ..sources import readers, sinks
from .storage import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Two versions of the orders -----------------------------------------------------------------------

_ORDERS = """
WITH e AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0),
f AS (SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice) FROM orders WHERE o_orderkey % 7 <> 0),
c AS (
  SELECT coalesce(e.o_orderkey, f.o_orderkey) AS o_orderkey, CASE WHEN e.o_orderkey IS NULL THEN 'I' WHEN f.o_orderkey IS NULL THEN 'D'
    WHEN round(e.o_totalprice * 10000) <> round(f.o_totalprice * 10000) THEN 'U' ELSE 'S' END AS change,
    e.o_orderdate AS ed, f.o_orderdate AS fd
  FROM e FULL JOIN f ON e.o_orderkey = f.o_orderkey
)
"""


def _existing(spark: SparkSession, folder: str) -> DataFrame:
    return add_row_hash(_t(spark, folder, "orders").where("o_orderkey % 10 <> 0"), portable=True)


def _fresh(spark: SparkSession, folder: str) -> DataFrame:
    o = _t(spark, folder, "orders").where("o_orderkey % 7 <> 0")
    return add_row_hash(o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)), portable=True)


@_query(_ORDERS + "SELECT o_orderkey, change FROM c")
def cdc_classify(spark, folder):
    return cdc.classify(_existing(spark, folder), _fresh(spark, folder), ["o_orderkey"])


@_query(_ORDERS + """SELECT count(*) FILTER (change = 'I') AS inserts, count(*) FILTER (change = 'U') AS updates, count(*) FILTER (change = 'D') AS deletes,
  count(*) FILTER (change = 'S') AS unchanged, count(*) FILTER (change = 'U') / count(*) FILTER (change <> 'D') AS update_ratio,
  count(*) FILTER (change = 'U') / count(*) FILTER (change <> 'D') > 0.5 AND count(*) FILTER (change = 'U') > 1000 AS alarm FROM c""")
def cdc_counts(spark, folder):
    return cdc.phantom_updates(cdc.change_counts(cdc_classify(spark, folder)))


@_query(_ORDERS + """SELECT o_orderkey, change FROM c WHERE coalesce(ed, fd) >= TIMESTAMP '1995-01-01' AND coalesce(ed, fd) < TIMESTAMP '1996-01-01'""")
def cdc_windowed(spark, folder):
    return cdc.classify_window(_existing(spark, folder), _fresh(spark, folder), ["o_orderkey"], "o_orderdate", "1995-01-01", "1996-01-01")


@_query(_ORDERS + "SELECT o_orderkey, change FROM c WHERE change <> 'D' OR o_orderkey % 14 <> 0")
def cdc_verified_deletes(spark, folder):
    still = _t(spark, folder, "orders").where("o_orderkey % 14 = 0")
    return cdc.verify_deletes(cdc_classify(spark, folder), still, ["o_orderkey"], limit=0)


@_query(_ORDERS + """SELECT e.o_orderkey, 'I' AS op, CAST(CASE WHEN change = 'S' THEN 1 ELSE 0 END AS TINYINT) AS is_current, TIMESTAMP '2026-01-01' AS valid_from,
  CASE WHEN change <> 'S' THEN TIMESTAMP '2026-01-02' END AS valid_to, CAST(1 AS BIGINT) AS batch FROM e JOIN c USING (o_orderkey)
UNION ALL SELECT o_orderkey, change, CAST(1 AS TINYINT), TIMESTAMP '2026-01-02', NULL, CAST(2 AS BIGINT) FROM c WHERE change IN ('I', 'U')""")
def cdc_stage_apply(spark, folder):
    stage = cleaning.add_cdc_columns(_existing(spark, folder), "I", "2026-01-01", 1)
    out = cdc.apply_to_stage(stage, _fresh(spark, folder), ["o_orderkey"], "2026-01-02", 2)
    return out.select(
        "o_orderkey", F.col("_cdc_operation").alias("op"), F.col("_cdc_is_current").alias("is_current"), F.col("_cdc_valid_from").alias("valid_from"),
        F.col("_cdc_valid_to").alias("valid_to"), F.col("_cdc_batch_id").alias("batch"),
    )


@_query("SELECT event_id, 'A' AS op, CAST(7 AS BIGINT) AS batch FROM events")
def cdc_append_only(spark, folder):
    out = cdc.append_only(_t(spark, folder, "events"), "2026-01-01", 7)
    return out.select("event_id", F.col("_cdc_operation").alias("op"), F.col("_cdc_batch_id").alias("batch"))


@_query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0""")
def cdc_snapshot_deletes(spark, folder):
    return cdc.snapshot_deletes(_existing(spark, folder), _fresh(spark, folder), ["o_orderkey"])


@_query("""SELECT change_id, _cdc_batch_id AS batch FROM acct_change
WHERE NOT coalesce(_cdc_is_current = 0 AND _cdc_valid_to < TIMESTAMP '2026-04-01' - INTERVAL 30 DAY, false)""")
def cdc_purge_expired(spark, folder):
    return cdc.purge_expired(_t(spark, folder, "acct_change"), "2026-04-01", 30).select("change_id", F.col("_cdc_batch_id").alias("batch"))


# Hashes -------------------------------------------------------------------------------------------

_NUL = "chr(31) || 'NULL' || chr(31)"


def _double_text(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN {_NUL} WHEN isnan({c}) THEN chr(31) || 'NaN' || chr(31) ELSE CAST(CAST(round({c} * 10000) AS BIGINT) AS VARCHAR) END"


def _string_text(c: str) -> str:
    return f"coalesce(rtrim(nfc_normalize({c}), ' '), {_NUL})"


def _other_text(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), {_NUL})"


_HASHED = [
    _other_text("branchnbr"), _string_text("mjaccttypcd"), _string_text("acctstatcd"), _string_text("acctname"), _double_text("curbal"),
    _double_text("intrate"), _other_text("opendate"),
]


@_query(f"SELECT batch_id, acctnbr, sha256(concat_ws(chr(31), {', '.join(_HASHED)})) AS row_hash FROM acct_source")
def row_hashes(spark, folder):
    df = _t(spark, folder, "acct_source")
    return df.select("batch_id", "acctnbr", row_hash(df, ["batch_id", "acctnbr", "note"], portable=True).alias("row_hash"))


@_query("""SELECT o_orderkey, sha256(concat_ws(chr(31), CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(CAST(round(o_totalprice * 10000) AS BIGINT) AS VARCHAR),
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), o_orderpriority)) AS row_hash FROM orders""")
def row_hashes_orders(spark, folder):
    df = _t(spark, folder, "orders")
    return df.select("o_orderkey", row_hash(df, portable=True).alias("row_hash"))


# A history of customers over three loads ----------------------------------------------------------

_DAYS = ("2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00")


def _load(spark: SparkSession, folder: str, n: int) -> DataFrame:
    c = _t(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    if n == 2:
        c = c.where("c_custkey % 11 <> 0").withColumn("c_acctbal", F.col("c_acctbal") + F.when(k % 5 == 0, 10).otherwise(0))
    elif n == 3:
        c = c.where("c_custkey % 13 <> 0").withColumn("c_acctbal", F.col("c_acctbal") + F.when(k % 5 == 0, 10).otherwise(0) + F.when(k % 6 == 0, 3).otherwise(0))
    else:
        c = c.where("c_custkey % 17 <> 0")
    return add_row_hash(c, portable=True)


def _bronze(spark: SparkSession, folder: str, loads: int = 3) -> DataFrame:
    b = scd2.first_load(_load(spark, folder, 1), ["c_custkey"], _DAYS[0])
    for n in range(2, loads + 1):
        b = scd2.apply(b, _load(spark, folder, n), ["c_custkey"], _DAYS[n - 1])
    return b


_LOADS = """
WITH l AS (
  SELECT c_custkey, 1 AS n, c_acctbal AS v FROM customer WHERE c_custkey % 17 <> 0
  UNION ALL SELECT c_custkey, 2, c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN 10 ELSE 0 END FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey, 3, c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN 10 ELSE 0 END + CASE WHEN c_custkey % 6 = 0 THEN 3 ELSE 0 END FROM customer WHERE c_custkey % 13 <> 0
), g AS (
  SELECT c_custkey, n, v, lag(n) OVER w AS pn, lag(v) OVER w AS pv FROM l WHERE n <= {n} WINDOW w AS (PARTITION BY c_custkey ORDER BY n)
), s AS (SELECT *, CASE WHEN pn IS NULL THEN 'I' WHEN pn < n - 1 THEN 'R' WHEN round(v * 10000) <> round(pv * 10000) THEN 'U' END AS op FROM g),
p AS (SELECT c_custkey, n, v, op, lead(n) OVER (PARTITION BY c_custkey ORDER BY n) AS nn FROM s WHERE op IS NOT NULL),
q AS (SELECT p.*, (SELECT max(l.n) FROM l WHERE l.c_custkey = p.c_custkey AND l.n >= p.n AND l.n < coalesce(p.nn, 99) AND l.n <= {n}) AS ln FROM p),
d AS (SELECT * FROM (VALUES (1, TIMESTAMP '2026-01-01'), (2, TIMESTAMP '2026-02-01'), (3, TIMESTAMP '2026-03-01')) x(n, tm)),
h AS (
  SELECT c_custkey, v AS c_acctbal, b.tm AS eff, CASE WHEN ln < coalesce(nn, {n} + 1) - 1 THEN ed.tm WHEN nn IS NOT NULL THEN ud.tm END AS fin,
    CASE WHEN ln < coalesce(nn, {n} + 1) - 1 THEN ed.tm WHEN nn IS NOT NULL THEN ud.tm - INTERVAL 1 DAY ELSE TIMESTAMP '2999-12-31' END AS send,
    CAST(CASE WHEN ln < coalesce(nn, {n} + 1) - 1 THEN 2 WHEN nn IS NOT NULL THEN 0 ELSE 1 END AS TINYINT) AS flag, op
  FROM q JOIN d b ON b.n = q.n LEFT JOIN d ed ON ed.n = q.ln + 1 LEFT JOIN d ud ON ud.n = q.nn
)
"""
_H = "SELECT c_custkey, c_acctbal, eff, fin, send, flag, op FROM h"


def _short(b: DataFrame) -> DataFrame:
    return b.select(
        "c_custkey", "c_acctbal", F.col("UdmEffectiveDateTime").alias("eff"), F.col("UdmEndDateTime").alias("fin"), F.col("UdmSourceEndDate").alias("send"),
        F.col("UdmActiveFlag").alias("flag"), F.col("UdmScd2Operation").alias("op"),
    )


@_query(_LOADS.format(n=2) + _H)
def scd2_apply(spark, folder):
    return _short(_bronze(spark, folder, 2))


@_query(_LOADS.format(n=3) + _H)
def scd2_resurrection(spark, folder):
    return _short(_bronze(spark, folder, 3))


@_query(_LOADS.format(n=3) + _H + " WHERE flag = 2")
def scd2_delete_close(spark, folder):
    return _short(_bronze(spark, folder, 3)).where("flag = 2")


@_query("""
WITH b AS (SELECT c_custkey, c_acctbal AS v FROM customer WHERE c_custkey % 17 <> 0),
f AS (SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN 10 ELSE 0 END AS v FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 4 = 0),
d AS (SELECT c_custkey FROM customer WHERE c_custkey % 44 = 0)
SELECT b.c_custkey, b.v AS c_acctbal, CAST(CASE WHEN d.c_custkey IS NOT NULL THEN 2 WHEN f.v <> b.v THEN 0 ELSE 1 END AS TINYINT) AS flag, 'I' AS op
FROM b LEFT JOIN f USING (c_custkey) LEFT JOIN d USING (c_custkey)
UNION ALL SELECT f.c_custkey, f.v, CAST(1 AS TINYINT), CASE WHEN b.c_custkey IS NULL THEN 'I' ELSE 'U' END FROM f LEFT JOIN b USING (c_custkey) WHERE b.v IS NULL OR b.v <> f.v
""")
def scd2_targeted(spark, folder):
    part = _load(spark, folder, 2).where("c_custkey % 4 = 0")
    gone = _t(spark, folder, "customer").where("c_custkey % 44 = 0")
    out = scd2.apply(_bronze(spark, folder, 1), part, ["c_custkey"], _DAYS[1], deleted=gone)
    return _short(out).select("c_custkey", "c_acctbal", "flag", "op")


@_query("""SELECT _scd2_key, coalesce(UdmSourceBeginDate, UdmEffectiveDateTime) AS pick,
  date_trunc('millisecond', coalesce(UdmSourceEndDate, UdmSourceBeginDate, TIMESTAMP '1900-01-01')) AS begin_at FROM pers_bronze""")
def scd2_waterfall_begin(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    begin = scd2.source_begin(b, ["UdmSourceEndDate", "UdmSourceBeginDate"], "1900-01-01", "2026-01-01")
    return b.select("_scd2_key", F.coalesce("UdmSourceBeginDate", "UdmEffectiveDateTime").alias("pick"), begin.alias("begin_at"))


@_query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type || '|' || CAST(CAST(round(value * 10000) AS BIGINT) AS VARCHAR) AS h,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events),
s AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY day) AS ph FROM d WHERE rn = 1),
p AS (SELECT user_id, h, day AS "begin", lead(day) OVER (PARTITION BY user_id ORDER BY day) AS "end" FROM s WHERE ph IS NULL OR ph <> h)
SELECT user_id, h, "begin", "end", CAST("end" IS NULL AS INTEGER) AS active FROM p""")
def scd2_from_events(spark, folder):
    e = _t(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    daily = cleaning.keep_first(e, ["user_id", "day"], [F.desc("ts"), F.desc("event_id")])
    states = daily.select("user_id", "day", F.concat_ws("|", "event_type", F.round(F.col("value") * 10_000).cast("bigint").cast("string")).alias("h"))
    return scd2.from_states(states, ["user_id"], "day", "h")


@_query("""SELECT _scd2_key FROM pers_bronze WHERE NOT coalesce(UdmActiveFlag = 0 AND UdmScd2Operation IN ('U', 'R') AND UdmEndDateTime IS NULL AND UdmSourceEndDate IS NULL, false)""")
def scd2_orphan_cleanup(spark, folder):
    return scd2.drop_in_flight(_t(spark, folder, "pers_bronze")).select("_scd2_key")


@_query("""WITH a AS (SELECT datediff('day', CAST(UdmSourceBeginDate AS DATE), DATE '2026-01-01') AS age FROM pers_bronze WHERE UdmActiveFlag = 1 AND persnbr % 5 = 0)
SELECT count(*) FILTER (age <= 365) AS within, count(*) FILTER (age > 365) AS exceeds, count(*) FILTER (age IS NULL) AS unknown,
  CAST(min(age) AS INTEGER) AS min_age, CAST(max(age) AS INTEGER) AS max_age FROM a""")
def retention_age(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    return scd2.retention(b, b.where("persnbr % 5 = 0"), ["persnbr"], "2026-01-01", 365)


@_query("""WITH a AS (SELECT datediff('day', CAST(UdmSourceBeginDate AS DATE), DATE '2026-01-01') AS age FROM pers_bronze WHERE UdmActiveFlag = 1 AND persnbr IS NOT NULL)
SELECT count(*) FILTER (age <= 365) AS within, count(*) FILTER (age > 365) AS exceeds, count(*) FILTER (age IS NULL) AS unknown,
  CAST(min(age) AS INTEGER) AS min_age, CAST(max(age) AS INTEGER) AS max_age FROM a""")
def retention_age_of_all(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    return scd2.retention(b, b, ["persnbr"], "2026-01-01", 365)


@_query("""SELECT _scd2_key, coalesce(UdmSourceBeginDate, UdmEffectiveDateTime) AS begin_at,
  CASE WHEN UdmActiveFlag = 1 THEN TIMESTAMP '2999-12-31' ELSE UdmEndDateTime END AS end_at,
  CASE UdmActiveFlag WHEN 1 THEN 'I' WHEN 2 THEN 'D' ELSE 'U' END AS op FROM pers_bronze""")
def legacy_seed(spark, folder):
    out = scd2.seed(_t(spark, folder, "pers_bronze"), ["UdmSourceBeginDate"])
    return out.select("_scd2_key", F.col("UdmSourceBeginDate").alias("begin_at"), F.col("UdmSourceEndDate").alias("end_at"), F.col("UdmScd2Operation").alias("op"))


# Reads --------------------------------------------------------------------------------------------


@_query("""SELECT persnbr, _scd2_key FROM (SELECT *, row_number() OVER (PARTITION BY persnbr ORDER BY UdmEffectiveDateTime DESC, _scd2_key DESC) AS rn FROM pers_bronze WHERE UdmActiveFlag = 1) WHERE rn = 1""")
def current_defensive(spark, folder):
    return reads.current_defensive(_t(spark, folder, "pers_bronze"), ["persnbr"]).select("persnbr", "_scd2_key")


@_query("SELECT persnbr, _scd2_key FROM pers_bronze WHERE UdmActiveFlag = 1")
def current_rows(spark, folder):
    return reads.current(_t(spark, folder, "pers_bronze")).select("persnbr", "_scd2_key")


@_query(_LOADS.format(n=3) + "SELECT c_custkey, c_acctbal FROM h WHERE eff <= TIMESTAMP '2026-02-15' AND (fin IS NULL OR fin > TIMESTAMP '2026-02-15')")
def asof_load(spark, folder):
    return reads.as_of_load(_bronze(spark, folder), "2026-02-15").select("c_custkey", "c_acctbal")


@_query(_LOADS.format(n=3) + "SELECT c_custkey, c_acctbal FROM h WHERE eff <= TIMESTAMP '2026-02-10' AND send >= TIMESTAMP '2026-02-10'")
def asof_business(spark, folder):
    return reads.as_of_business(_bronze(spark, folder), "2026-02-10").select("c_custkey", "c_acctbal")


@_query("SELECT persnbr, _scd2_key, UdmActiveFlag AS flag FROM pers_bronze WHERE persnbr IN (SELECT persnbr FROM pers_bronze WHERE persnbr % 20 = 0)")
def history_of_key(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    return reads.history_of(b, b.where("persnbr % 20 = 0"), ["persnbr"]).select("persnbr", "_scd2_key", F.col("UdmActiveFlag").alias("flag"))


@_query("SELECT persnbr, _scd2_key FROM pers_bronze WHERE UdmActiveFlag = 2 AND UdmEndDateTime >= TIMESTAMP '2024-06-01'")
def deleted_recent(spark, folder):
    return reads.deleted_since(_t(spark, folder, "pers_bronze"), "2024-06-01").select("persnbr", "_scd2_key")


@_query("SELECT DISTINCT persnbr FROM pers_bronze WHERE UdmActiveFlag = 2 AND persnbr % 3 = 0")
def deleted_keys(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    return reads.deleted_keys(b, b.where("persnbr % 3 = 0"), ["persnbr"])


@_query("SELECT DISTINCT persnbr FROM pers_bronze WHERE UdmActiveFlag = 2 AND persnbr IS NOT NULL")
def deleted_of_all_keys(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    return reads.deleted_keys(b, b, ["persnbr"])


# Cleaning -----------------------------------------------------------------------------------------


@_query("SELECT batch_id, acctnbr FROM acct_source WHERE batch_id IS NOT NULL AND acctnbr IS NOT NULL")
def null_pk_filter(spark, folder):
    return cleaning.drop_null_keys(_t(spark, folder, "acct_source"), ["batch_id", "acctnbr"]).select("batch_id", "acctnbr")


@_query("""SELECT count(*) AS total_rows, count(*) FILTER (acctnbr IS NULL OR batch_id IS NULL) AS null_key_rows,
  CASE WHEN count(*) FILTER (acctnbr IS NULL OR batch_id IS NULL) = 0 THEN 'OK' WHEN count(*) FILTER (acctnbr IS NULL OR batch_id IS NULL) > count(*) * 0.01 THEN 'ERROR' ELSE 'WARN' END AS level FROM acct_source""")
def null_pk_report(spark, folder):
    return cleaning.null_key_report(_t(spark, folder, "acct_source"), ["batch_id", "acctnbr"])


@_query("SELECT doc_id, CASE WHEN trim(text, ' ') = '' THEN '<BLANK>' ELSE text END AS text FROM documents")
def blank_pk(spark, folder):
    return cleaning.coerce_blank_keys(_t(spark, folder, "documents").select("doc_id", "text"), ["text"])


@_query("""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_order_spec(spark, folder):
    df = _t(spark, folder, "lineitem")
    return cleaning.dedup_by_order(df, ["l_orderkey", "l_linenumber"], "l_shipdate, l_partkey ASC").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, folder):
    return cleaning.duplicate_keys(_t(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 5")
def key_uniqueness(spark, folder):
    return cleaning.key_uniqueness(_t(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


_CONTROL = "'[\\t\\n\\r\\x00\\x0B\\x0C\\x{85}\\x{2028}\\x{2029}]'"


@_query(f"SELECT doc_id, regexp_replace(text, {_CONTROL}, '', 'g') AS text FROM documents")
def sanitize_strings(spark, folder):
    return cleaning.sanitize_strings(_t(spark, folder, "documents").select("doc_id", "text"))


@_query(f"SELECT 'text' AS column_name, count(*) FILTER (regexp_matches(text, {_CONTROL})) AS bad_values FROM documents")
def unsanitized(spark, folder):
    return cleaning.unsanitized(_t(spark, folder, "documents"), ["text"])


@_query("""SELECT doc_id, regexp_replace('user_password = ' || text, '(?i)([\\w_]*password)\\s*[=:]\\s*\\S+', '\\1=***', 'g') AS text
FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '^[\\x21-\\x7e]')""")
def redact_text(spark, folder):
    d = _t(spark, folder, "documents").where(F.col("text").rlike(r"^[\x21-\x7e]"))
    return d.select("doc_id", cleaning.redact(F.concat(F.lit("user_password = "), "text")).alias("text"))


@_query("""SELECT doc_id, regexp_replace('user_password = ' || text, '(?i)([\\w_]*password)\\s*[=:]\\s*\\S+', '\\1=***', 'g') AS text FROM documents""")
def redact_every_text(spark, folder):
    d = _t(spark, folder, "documents")
    return d.select("doc_id", cleaning.redact(F.concat(F.lit("user_password = "), "text")).alias("text"))


@_query("""WITH o(name, type) AS (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderpriority', 'string')),
l(name, type) AS (VALUES ('o_orderkeys', 'bigint'), ('o_custid', 'bigint'), ('o_ordstatus', 'string'), ('o_price', 'double'))
SELECT o.name AS old_name, l.name AS new_name, CAST(levenshtein(o.name, l.name) AS INTEGER) AS distance FROM o JOIN l USING (type) WHERE levenshtein(o.name, l.name) <= 3""")
def rename_candidates(spark, folder):
    old = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderpriority", "string")]
    new = [("o_orderkeys", "bigint"), ("o_custid", "bigint"), ("o_ordstatus", "string"), ("o_price", "double")]
    return cleaning.rename_candidates(*[spark.createDataFrame(x, "name string, type string") for x in (old, new)])


@_query("""SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS BIGINT) AS n, o_orderstatus AS s FROM orders
UNION ALL SELECT c_name, c_custkey, NULL FROM customer""")
def safe_concat(spark, folder):
    o = _t(spark, folder, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("int").alias("n"), F.col("o_orderstatus").alias("s"))
    c = _t(spark, folder, "customer").select(F.col("c_name").alias("k"), F.col("c_custkey").alias("n"))
    return cleaning.safe_concat([o, c])


@_query("""SELECT c_custkey, TRY_CAST(c_name AS BIGINT) AS c_name, CAST(NULL AS VARCHAR) AS missing, CAST(c_nationkey AS DOUBLE) AS c_nationkey FROM customer""")
def conform_schema(spark, folder):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.LongType()), T.StructField("missing", T.StringType()), T.StructField("c_nationkey", T.DoubleType())])
    return cleaning.conform(_t(spark, folder, "customer"), schema)


@_query("""SELECT c AS column_name, a AS before_rate, b AS after_rate, b - a > CASE WHEN c = 'acctnbr' THEN 0 ELSE 0.01 END AS inflated FROM (
SELECT unnest(['acctnbr', 'acctname', 'note']) AS c, unnest((SELECT [avg((acctnbr IS NULL)::DOUBLE), avg((acctname IS NULL)::DOUBLE), avg((note IS NULL)::DOUBLE)] FROM acct_source)) AS a,
 unnest((SELECT [avg((acctnbr IS NULL)::DOUBLE), avg((acctname IS NULL)::DOUBLE), avg((note IS NULL)::DOUBLE)] FROM acct_stage)) AS b)""")
def null_inflation(spark, folder):
    cols = ["acctnbr", "acctname", "note"]
    return cleaning.null_inflation(_t(spark, folder, "acct_source").select(*cols), _t(spark, folder, "acct_stage").select(*cols), ["acctnbr"])


@_query("SELECT persnbr, _scd2_key, sha256('k|NAME|' || persname) AS persname FROM pers_bronze")
def tokenise(spark, folder):
    return cleaning.tokenise(_t(spark, folder, "pers_bronze").select("persnbr", "_scd2_key", "persname"), ["persname"], "k", "NAME")


@_query("SELECT _scd2_key, persname FROM pers_bronze")
def detokenise(spark, folder):
    b = _t(spark, folder, "pers_bronze").select("_scd2_key", "persname")
    return cleaning.detokenise(cleaning.tokenise(b, ["persname"], "k", "NAME"), "persname", cleaning.token_map(b, ["persname"], "k", "NAME"))


@_query("SELECT count(*) FILTER (try_strptime(note, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d']) IS NOT NULL) AS parsed, count(note) AS filled, false AS is_time FROM acct_source")
def time_columns(spark, folder):
    return cleaning.looks_like_times(_t(spark, folder, "acct_source"), "note")


# Integrity ----------------------------------------------------------------------------------------

_B = "pers_bronze WHERE persnbr IS NOT NULL"
_INTEGRITY = f"""
SELECT 'missing_sentinel' AS check_name, count(*) FILTER (UdmActiveFlag = 1 AND (UdmSourceEndDate IS NULL OR UdmSourceEndDate <> TIMESTAMP '2999-12-31')) AS violations FROM pers_bronze
UNION ALL SELECT 'active_with_end', count(*) FILTER (UdmActiveFlag = 1 AND UdmEndDateTime IS NOT NULL) FROM pers_bronze
UNION ALL SELECT 'bad_flag', count(*) FILTER (UdmActiveFlag IS NULL OR UdmActiveFlag NOT IN (0, 1, 2)) FROM pers_bronze
UNION ALL SELECT 'bad_operation', count(*) FILTER (UdmScd2Operation IS NULL OR UdmScd2Operation NOT IN ('I', 'U', 'R', 'D')) FROM pers_bronze
UNION ALL SELECT 'in_flight', count(*) FILTER (UdmActiveFlag = 0 AND UdmScd2Operation IN ('U', 'R') AND UdmEndDateTime IS NULL AND UdmSourceEndDate IS NULL) FROM pers_bronze
UNION ALL SELECT 'deleted_without_end', count(*) FILTER (UdmActiveFlag = 2 AND UdmEndDateTime IS NULL) FROM pers_bronze
UNION ALL SELECT 'deleted_with_sentinel', count(*) FILTER (UdmActiveFlag = 2 AND UdmSourceEndDate = TIMESTAMP '2999-12-31') FROM pers_bronze
UNION ALL SELECT 'zero_active', count(*) FROM (SELECT persnbr FROM {_B} GROUP BY 1 HAVING count(*) FILTER (UdmActiveFlag IN (1, 2)) = 0)
UNION ALL SELECT 'duplicate_active', count(*) FROM (SELECT persnbr FROM {_B} GROUP BY 1 HAVING count(*) FILTER (UdmActiveFlag = 1) > 1)
UNION ALL SELECT 'active_and_deleted', count(*) FROM (SELECT persnbr FROM {_B} GROUP BY 1 HAVING count(*) FILTER (UdmActiveFlag = 1) > 0 AND count(*) FILTER (UdmActiveFlag = 2) > 0)
UNION ALL SELECT 'overlap', count(*) FROM (SELECT DISTINCT persnbr FROM (SELECT persnbr, UdmEffectiveDateTime AS b, max(coalesce(UdmEndDateTime, TIMESTAMP '9999-12-31')) OVER (
  PARTITION BY persnbr ORDER BY UdmEffectiveDateTime, coalesce(UdmEndDateTime, TIMESTAMP '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM {_B}) WHERE b < m)
UNION ALL SELECT 'version_gap', count(DISTINCT persnbr) FROM (SELECT persnbr, UdmEffectiveDateTime AS b, lag(coalesce(UdmEndDateTime, TIMESTAMP '9999-12-31')) OVER (PARTITION BY persnbr ORDER BY UdmEffectiveDateTime, _scd2_key) AS p FROM {_B})
  WHERE floor(epoch_us(b) / 1000000) - floor(epoch_us(p) / 1000000) > 1
UNION ALL SELECT 'business_overlap', count(DISTINCT a.persnbr) FROM pers_bronze a JOIN pers_bronze b ON a.persnbr = b.persnbr AND a._scd2_key <> b._scd2_key
  AND a.UdmSourceBeginDate < b.UdmSourceEndDate AND b.UdmSourceBeginDate < a.UdmSourceEndDate
UNION ALL SELECT 'business_gap', count(DISTINCT persnbr) FROM (SELECT persnbr, UdmSourceBeginDate AS b, lag(UdmSourceEndDate) OVER (PARTITION BY persnbr ORDER BY UdmSourceBeginDate, _scd2_key) AS p FROM {_B})
  WHERE p < TIMESTAMP '2999-12-31' AND datediff('day', CAST(p AS DATE), CAST(b AS DATE)) > 1
"""


@_query(_INTEGRITY)
def integrity_checks(spark, folder):
    return integrity.integrity(_t(spark, folder, "pers_bronze"), ["persnbr"])


@_query(f"""SELECT DISTINCT a.persnbr FROM pers_bronze a JOIN pers_bronze b ON a.persnbr = b.persnbr AND a._scd2_key <> b._scd2_key
WHERE a.UdmEffectiveDateTime < coalesce(b.UdmEndDateTime, TIMESTAMP '9999-12-31') AND b.UdmEffectiveDateTime < coalesce(a.UdmEndDateTime, TIMESTAMP '9999-12-31')""")
def overlap_keys(spark, folder):
    return integrity.overlapping(_t(spark, folder, "pers_bronze"), ["persnbr"])


@_query(f"""SELECT persnbr, count(*) AS gaps FROM (SELECT persnbr, UdmEffectiveDateTime AS b, lag(coalesce(UdmEndDateTime, TIMESTAMP '9999-12-31')) OVER (PARTITION BY persnbr ORDER BY UdmEffectiveDateTime, _scd2_key) AS p FROM {_B})
WHERE floor(epoch_us(b) / 1000000) - floor(epoch_us(p) / 1000000) > 1 GROUP BY 1""")
def version_gaps(spark, folder):
    return integrity.version_gaps(_t(spark, folder, "pers_bronze"), ["persnbr"])


@_query("""WITH r AS (SELECT *, row_number() OVER w AS rn, first_value(UdmEffectiveDateTime) OVER w AS fe, first_value(UdmSourceBeginDate) OVER w AS fs FROM pers_bronze WHERE UdmActiveFlag = 1
  WINDOW w AS (PARTITION BY persnbr ORDER BY UdmEffectiveDateTime DESC, _scd2_key DESC))
SELECT _scd2_key, CAST(CASE WHEN rn > 1 THEN 0 ELSE 1 END AS TINYINT) AS flag, CASE WHEN rn > 1 THEN fe ELSE UdmEndDateTime END AS fin, CASE WHEN rn > 1 THEN fs - INTERVAL 1 DAY ELSE UdmSourceEndDate END AS send FROM r
UNION ALL SELECT _scd2_key, UdmActiveFlag, UdmEndDateTime, UdmSourceEndDate FROM pers_bronze WHERE UdmActiveFlag <> 1 OR UdmActiveFlag IS NULL""")
def repair_duplicate_active(spark, folder):
    out = integrity.repair_duplicate_active(_t(spark, folder, "pers_bronze"), ["persnbr"])
    return out.select("_scd2_key", F.col("UdmActiveFlag").alias("flag"), F.col("UdmEndDateTime").alias("fin"), F.col("UdmSourceEndDate").alias("send"))


@_query("SELECT _scd2_key, CASE WHEN UdmActiveFlag = 1 THEN coalesce(UdmSourceEndDate, TIMESTAMP '2999-12-31') ELSE UdmSourceEndDate END AS send FROM pers_bronze")
def repair_sentinel(spark, folder):
    return integrity.repair_sentinel(_t(spark, folder, "pers_bronze")).select("_scd2_key", F.col("UdmSourceEndDate").alias("send"))


@_query(f"SELECT count(*) AS keys, avg(n) AS avg_versions, max(n) AS max_versions, count(*) FILTER (n > 10) AS high_keys FROM (SELECT count(*) AS n FROM {_B} GROUP BY persnbr)")
def velocity(spark, folder):
    return integrity.velocity(_t(spark, folder, "pers_bronze"), ["persnbr"])


@_query(f"SELECT n AS versions, count(*) AS keys FROM (SELECT count(*) AS n FROM {_B} GROUP BY persnbr) GROUP BY n")
def version_histogram(spark, folder):
    return integrity.version_histogram(_t(spark, folder, "pers_bronze"), ["persnbr"])


_STAGE = "WITH st AS (SELECT acctnbr + 0 AS persnbr, * FROM acct_change WHERE acctnbr IS NOT NULL)"


def _accounts_as_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """A history of accounts from the change log: current rows active, ended ones replaced, D deleted."""
    c = _t(spark, folder, "acct_change").where("acctnbr IS NOT NULL AND acctnbr % 9 <> 0")
    return c.select(
        "acctnbr",
        F.when(F.col("acctnbr") % 7 == 0, F.reverse("_row_hash")).otherwise(F.col("_row_hash")).alias("UdmHash"),
        F.col("_cdc_valid_from").alias("UdmEffectiveDateTime"),
        F.col("_cdc_valid_to").alias("UdmEndDateTime"),
        F.col("_cdc_valid_from").alias("UdmSourceBeginDate"),
        F.lit(None).cast("timestamp_ntz").alias("UdmSourceEndDate"),
        F.when(F.col("_cdc_operation").startswith("D"), 2).when(F.col("_cdc_is_current") == 1, 1).otherwise(0).cast("tinyint").alias("UdmActiveFlag"),
        F.col("_cdc_operation").alias("UdmScd2Operation"),
    )


_ACCT = """WITH s AS (SELECT acctnbr, count(*) FILTER (_cdc_is_current = 1) AS c, max(_row_hash) FILTER (_cdc_is_current = 1) AS sh FROM acct_change WHERE acctnbr IS NOT NULL GROUP BY 1),
br AS (SELECT acctnbr, CASE WHEN acctnbr % 7 = 0 THEN reverse(_row_hash) ELSE _row_hash END AS h, _cdc_valid_from AS b, _cdc_valid_to AS e, _cdc_operation AS op,
  CASE WHEN starts_with(_cdc_operation, 'D') THEN 2 WHEN _cdc_is_current = 1 THEN 1 ELSE 0 END AS f FROM acct_change WHERE acctnbr IS NOT NULL AND acctnbr % 9 <> 0),
b AS (SELECT acctnbr, count(*) AS n, count(*) FILTER (f = 0) AS z, count(*) FILTER (f = 1) AS a, count(*) FILTER (f = 2) AS d, count(*) FILTER (f = 0 AND op IN ('U', 'R') AND e IS NULL) AS i, max(h) FILTER (f = 1) AS bh FROM br GROUP BY 1)
"""


@_query(_ACCT + """SELECT coalesce(s.acctnbr, b.acctnbr, q.acctnbr) AS acctnbr, CASE
  WHEN coalesce(c, 0) = 1 AND coalesce(a, 0) = 1 THEN CASE WHEN sh IS NOT DISTINCT FROM bh THEN 'HEALTHY_ACTIVE' ELSE 'STAGE_BRONZE_HASH_DIVERGE' END
  WHEN coalesce(c, 0) = 0 AND coalesce(d, 0) >= 1 AND coalesce(a, 0) = 0 THEN 'HEALTHY_DELETED' WHEN coalesce(i, 0) > 0 THEN 'IN_FLIGHT_ORPHAN'
  WHEN coalesce(c, 0) > 1 THEN 'DUPLICATE_CURRENT_STAGE' WHEN coalesce(a, 0) > 1 THEN 'DUPLICATE_ACTIVE_BRONZE'
  WHEN coalesce(c, 0) = 1 AND coalesce(a, 0) = 0 AND coalesce(d, 0) = 0 THEN CASE WHEN coalesce(n, 0) = 0 THEN 'STAGE_CURRENT_NO_BRONZE_ROWS' ELSE 'STAGE_CURRENT_NO_BRONZE_ACTIVE' END
  WHEN coalesce(c, 0) = 0 AND coalesce(a, 0) >= 1 THEN CASE WHEN q.acctnbr IS NOT NULL THEN 'BRONZE_ACTIVE_NO_STAGE_CURRENT_PK_IN_SOURCE' ELSE 'BRONZE_ACTIVE_NO_STAGE_CURRENT_PK_NOT_IN_SOURCE' END
  WHEN coalesce(c, 0) = 0 AND coalesce(n, 0) = 0 AND q.acctnbr IS NOT NULL THEN 'NEW_PK_NOT_YET_LOADED' WHEN coalesce(c, 0) = 0 AND coalesce(n, 0) = 0 THEN 'NOT_FOUND' ELSE 'UNKNOWN' END AS verdict
FROM s FULL JOIN b ON s.acctnbr = b.acctnbr FULL JOIN (SELECT DISTINCT acctnbr FROM acct_snapshot WHERE acctnbr IS NOT NULL) q ON coalesce(s.acctnbr, b.acctnbr) = q.acctnbr""")
def diagnose_keys(spark, folder):
    return integrity.diagnose(_t(spark, folder, "acct_change"), _accounts_as_bronze(spark, folder), _t(spark, folder, "acct_snapshot"), ["acctnbr"])


@_query(_ACCT + """SELECT s.acctnbr, CASE WHEN n IS NULL THEN 'T3_NEVER_INSERTED' WHEN i > 0 THEN 'T1_IN_FLIGHT_ORPHAN' WHEN d >= 1 AND z >= 1 AND a = 0 THEN 'T5_RESURRECTED_AS_INACTIVE'
  WHEN d >= 1 AND a = 0 THEN 'T2_DELETED_FROM_SOURCE' WHEN z >= 1 AND a = 0 AND d = 0 THEN 'T4_ALL_CLOSED' ELSE 'UNKNOWN' END AS theory FROM s LEFT JOIN b USING (acctnbr)""")
def missing_theories(spark, folder):
    keys = _t(spark, folder, "acct_change").where("acctnbr IS NOT NULL").select("acctnbr")
    return integrity.missing_theories(keys, _accounts_as_bronze(spark, folder), ["acctnbr"])


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 97 = 0")
def fk_orphans(spark, folder):
    dim = _t(spark, folder, "orders").where("o_orderkey % 97 <> 0")
    return integrity.fk_orphans(_t(spark, folder, "lineitem"), dim, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


@_query(_ACCT + """SELECT e.event_id FROM (SELECT event_id, 1000000 + user_id AS k, ts + INTERVAL 735 DAY AS at FROM events) e
WHERE NOT EXISTS (SELECT 1 FROM br WHERE br.acctnbr = e.k AND br.b <= e.at AND (br.e IS NULL OR e.at < br.e))""")
def fk_temporal(spark, folder):
    e = _t(spark, folder, "events").select("event_id", (F.col("user_id") + 1_000_000).alias("k"), (F.col("ts") + F.expr("INTERVAL 735 DAYS")).alias("at"))
    return integrity.fk_orphans_at(e, _accounts_as_bronze(spark, folder), "k", "acctnbr", "at").select("event_id")


@_query(_ACCT + """SELECT e.event_id, count(*) AS n FROM (SELECT event_id, 1000000 + user_id AS k, ts + INTERVAL 735 DAY AS at FROM events) e
JOIN br ON br.acctnbr = e.k AND br.b <= e.at AND (br.e IS NULL OR e.at < br.e) GROUP BY 1 HAVING count(*) > 1""")
def fk_ambiguous(spark, folder):
    e = _t(spark, folder, "events").select("event_id", (F.col("user_id") + 1_000_000).alias("k"), (F.col("ts") + F.expr("INTERVAL 735 DAYS")).alias("at"))
    return integrity.fk_ambiguous(e, _accounts_as_bronze(spark, folder), "k", "acctnbr", "at", "event_id")


@_query(_LOADS.format(n=3) + """SELECT o_orderkey, h.c_acctbal, h.op FROM (SELECT o_orderkey, o_custkey, TIMESTAMP '2026-01-01' + to_days(CAST(o_orderkey % 90 AS INTEGER)) AS at FROM orders) o
LEFT JOIN h ON h.c_custkey = o.o_custkey AND h.eff <= o.at AND (h.fin IS NULL OR o.at < h.fin)""")
def asof_join(spark, folder):
    at = F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("o_orderkey") % 90).cast("int"))
    o = _t(spark, folder, "orders").select("o_orderkey", "o_custkey", at.alias("at"))
    # The history is stored, as it would be; versions and carried rows both read it.
    out = reads.as_of_join(o, materialise(_bronze(spark, folder), "bronze"), "o_custkey", "c_custkey", "at")
    return out.select("o_orderkey", F.col("v_c_acctbal").alias("c_acctbal"), F.col("v_UdmScd2Operation").alias("op"))


# Reconciliation -----------------------------------------------------------------------------------

_COPIES = """WITH s AS (SELECT DISTINCT ON (batch_id, acctnbr) * FROM (SELECT * FROM acct_source ORDER BY ALL) WHERE acctnbr IS NOT NULL),
t AS (SELECT DISTINCT ON (batch_id, acctnbr) * FROM (SELECT * FROM acct_stage ORDER BY ALL) WHERE acctnbr IS NOT NULL)
"""


def _copy(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _t(spark, folder, name).where("acctnbr IS NOT NULL").groupBy("batch_id", "acctnbr").agg(*[F.max(c).alias(c) for c in ("branchnbr", "mjaccttypcd", "acctstatcd", "opendate")])


_MAXED = "SELECT batch_id, acctnbr, max(branchnbr) AS branchnbr, max(mjaccttypcd) AS mjaccttypcd, max(acctstatcd) AS acctstatcd, max(opendate) AS opendate FROM {} WHERE acctnbr IS NOT NULL GROUP BY 1, 2"
_MAX_COPIES = f"WITH s AS ({_MAXED.format('acct_source')}), t AS ({_MAXED.format('acct_stage')}), j AS (SELECT s.*, t.branchnbr AS b2, t.mjaccttypcd AS m2, t.acctstatcd AS a2, t.opendate AS o2 FROM s JOIN t USING (batch_id, acctnbr))"


@_query(_MAX_COPIES + """SELECT unnest(['branchnbr', 'mjaccttypcd', 'acctstatcd', 'opendate', 'any column']) AS column_name, unnest([count(*) FILTER (branchnbr IS DISTINCT FROM b2), count(*) FILTER (mjaccttypcd IS DISTINCT FROM m2),
  count(*) FILTER (acctstatcd IS DISTINCT FROM a2), count(*) FILTER (opendate IS DISTINCT FROM o2),
  count(*) FILTER (branchnbr IS DISTINCT FROM b2 OR mjaccttypcd IS DISTINCT FROM m2 OR acctstatcd IS DISTINCT FROM a2 OR opendate IS DISTINCT FROM o2)]) AS mismatches FROM j""")
def columns_compare(spark, folder):
    s, t = (_copy(spark, folder, n) for n in ("acct_source", "acct_stage"))
    return reconcile.columns_compare(s, t, ["batch_id", "acctnbr"], ["branchnbr", "mjaccttypcd", "acctstatcd", "opendate"])


@_query("""WITH s AS (SELECT DISTINCT batch_id, acctnbr FROM acct_source WHERE acctnbr IS NOT NULL), t AS (SELECT DISTINCT batch_id, acctnbr FROM acct_stage WHERE acctnbr IS NOT NULL),
c AS (SELECT count(*) FILTER (s.acctnbr IS NULL) AS ghosts, count(*) FILTER (t.acctnbr IS NULL) AS missing, count(*) FILTER (s.acctnbr IS NOT NULL AND t.acctnbr IS NOT NULL) AS common
  FROM s FULL JOIN t ON s.batch_id = t.batch_id AND s.acctnbr = t.acctnbr)
SELECT *, ghosts > (ghosts + common) * 0.001 AS alert FROM c""")
def ghost_keys(spark, folder):
    s, t = (_t(spark, folder, n).where("acctnbr IS NOT NULL") for n in ("acct_source", "acct_stage"))
    return reconcile.ghost_keys(s, t, ["batch_id", "acctnbr"])


@_query("""SELECT 'source' AS layer, count(*) AS row_count, CAST(0 AS BIGINT) AS delta FROM acct_source
UNION ALL SELECT 'stage', count(*), count(*) - (SELECT count(*) FROM acct_source) FROM acct_stage UNION ALL SELECT 'bronze', count(*), count(*) - (SELECT count(*) FROM acct_source) FROM pers_bronze""")
def layer_counts(spark, folder):
    return reconcile.count_deltas({"source": _t(spark, folder, "acct_source"), "stage": _t(spark, folder, "acct_stage"), "bronze": _t(spark, folder, "pers_bronze")}, "source")


@_query("""SELECT unnest(['o_totalprice', 'o_custkey']) AS column_name, unnest([count(o_totalprice), count(o_custkey)]) AS a_count, unnest([sum(o_totalprice), CAST(sum(o_custkey) AS DOUBLE)]) AS a_sum,
  unnest([count(o_totalprice) FILTER (o_orderkey % 7 <> 0), count(o_custkey) FILTER (o_orderkey % 7 <> 0)]) AS b_count, unnest([sum(o_totalprice) FILTER (o_orderkey % 7 <> 0), CAST(sum(o_custkey) FILTER (o_orderkey % 7 <> 0) AS DOUBLE)]) AS b_sum, true AS mismatch FROM orders""")
def aggregate_recon(spark, folder):
    o = _t(spark, folder, "orders")
    out = reconcile.aggregate_reconcile(o, o.where("o_orderkey % 7 <> 0"), ["o_totalprice", "o_custkey"])
    return out.withColumns({c: F.round(c, 2) for c in ("a_sum", "b_sum")})


SQL["aggregate_recon"] = f"SELECT column_name, a_count, round(a_sum, 2) AS a_sum, b_count, round(b_sum, 2) AS b_sum, mismatch FROM ({SQL['aggregate_recon']})"


@_query("""SELECT 'l_quantity' AS column_name, round(avg(l_quantity) FILTER (l_orderkey % 2 = 0), 6) AS base_mean, round(stddev_samp(l_quantity) FILTER (l_orderkey % 2 = 0), 6) AS base_std,
  round(avg(l_quantity) FILTER (l_orderkey % 2 = 1), 6) AS now_mean, false AS shifted FROM lineitem""")
def distribution_shift(spark, folder):
    df = _t(spark, folder, "lineitem")
    out = reconcile.distribution_shift(df.where("l_orderkey % 2 = 0"), df.where("l_orderkey % 2 = 1"), ["l_quantity"])
    return out.withColumns({c: F.round(c, 6) for c in ("base_mean", "base_std", "now_mean")})


@_query("""SELECT c AS column_name, a AS a_rate, b AS b_rate, abs(a - b) > 0.001 AS flagged FROM (SELECT unnest(['opendate', 'note', 'curbal']) AS c,
 unnest((SELECT [avg((opendate IS NULL)::DOUBLE), avg((note IS NULL)::DOUBLE), avg((curbal IS NULL)::DOUBLE)] FROM acct_source)) AS a,
 unnest((SELECT [avg((opendate IS NULL)::DOUBLE), avg((note IS NULL)::DOUBLE), avg((curbal IS NULL)::DOUBLE)] FROM acct_stage)) AS b)""")
def null_rates(spark, folder):
    return reconcile.null_rates(_t(spark, folder, "acct_source"), _t(spark, folder, "acct_stage"), ["opendate", "note", "curbal"], 0.001)


_LAST = """, cs AS (SELECT acctnbr, arg_max({'h': _row_hash}, (coalesce(_cdc_valid_from, TIMESTAMP '0001-01-01'), coalesce(_row_hash, ''))).h AS sh, true AS ins FROM acct_change WHERE _cdc_is_current = 1 AND acctnbr IS NOT NULL GROUP BY 1),
cb AS (SELECT acctnbr, arg_max({'h': h}, (coalesce(b, TIMESTAMP '0001-01-01'), coalesce(h, ''))).h AS bh, true AS inb FROM br WHERE f = 1 GROUP BY 1),
dr AS (SELECT coalesce(cs.acctnbr, cb.acctnbr) AS acctnbr, CASE WHEN inb IS NULL THEN 'stage_only' WHEN ins IS NULL THEN 'bronze_only' WHEN sh IS DISTINCT FROM bh THEN 'hash_mismatch' END AS kind FROM cs FULL JOIN cb ON cs.acctnbr = cb.acctnbr)
"""


@_query(_ACCT + _LAST + "SELECT acctnbr, kind FROM dr WHERE kind IS NOT NULL")
def drift_full_outer(spark, folder):
    return reconcile.drift(_t(spark, folder, "acct_change"), _accounts_as_bronze(spark, folder), ["acctnbr"])


@_query(_ACCT + _LAST + """SELECT count(*) FILTER (kind = 'bronze_only') AS orphans, count(*) FILTER (kind = 'stage_only') AS missing, count(*) FILTER (kind = 'hash_mismatch') AS hash_mismatches,
 (SELECT count(*) FROM s WHERE c > 1) AS stage_duplicates, (SELECT count(*) FROM b WHERE a > 1) AS bronze_duplicates FROM dr""")
def stage_against_bronze(spark, folder):
    return reconcile.stage_against_bronze(_t(spark, folder, "acct_change"), _accounts_as_bronze(spark, folder), ["acctnbr"])


@_query(_ACCT + """, la AS (SELECT acctnbr, max(b) AS b FROM br WHERE f = 1 GROUP BY 1), sn AS (SELECT acctnbr, max(_extracted_at) AS m FROM acct_snapshot WHERE acctnbr IS NOT NULL GROUP BY 1)
SELECT sn.acctnbr FROM sn LEFT JOIN la USING (acctnbr) WHERE la.b IS NULL OR sn.m > la.b""")
def modified_sweep(spark, folder):
    src = _t(spark, folder, "acct_snapshot").where("acctnbr IS NOT NULL").groupBy("acctnbr").agg(F.max("_extracted_at").alias("m"))
    return reconcile.modified_sweep(src, _accounts_as_bronze(spark, folder), ["acctnbr"], "m")


@_query("""WITH c AS (SELECT BatchId, CAST(RowsProcessed AS DOUBLE) AS p, CAST(lead(RowsProcessed) OVER (ORDER BY EventLogId, BatchId, EventType, StartedAt, DurationMs, RowsProcessed) AS DOUBLE) AS b FROM pipelineeventlog WHERE RowsProcessed IS NOT NULL)
SELECT BatchId, CASE WHEN p = 0 AND b = 0 THEN 'CLEAN' WHEN p = 0 OR b = 0 OR p < b THEN 'MAJOR_DRIFT' WHEN abs(p - b) / p <= 0.01 THEN 'CLEAN' WHEN abs(p - b) / p <= 0.05 THEN 'DRIFT' ELSE 'MAJOR_DRIFT' END AS verdict FROM c WHERE b IS NOT NULL""")
def parity_verdict(spark, folder):
    from pyspark.sql import Window

    e = _t(spark, folder, "pipelineeventlog").where("RowsProcessed IS NOT NULL")
    # The event log is a control table of fixed size; its order is over all rows.
    w = Window.orderBy("EventLogId", "BatchId", "EventType", "StartedAt", "DurationMs", "RowsProcessed")
    e = e.withColumn("b", F.lead("RowsProcessed").over(w)).where("b IS NOT NULL")
    return e.select("BatchId", reconcile.count_verdict(F.col("RowsProcessed"), F.col("b")).alias("verdict"))


_KEYS = _ORDERS + """, k AS (SELECT count(*) FILTER (change = 'D') AS missing_from_bronze, count(*) FILTER (change = 'I') AS missing_from_snapshot, count(*) FILTER (change = 'S') AS hash_same, count(*) FILTER (change = 'U') AS hash_differs FROM c)
"""


@_query(_KEYS + "SELECT *, 'MAJOR_DRIFT' AS verdict FROM k")
def hash_parity(spark, folder):
    out = reconcile.key_hashes(_existing(spark, folder), _fresh(spark, folder), ["o_orderkey"], "_row_hash", "_row_hash")
    return out.withColumn("verdict", reconcile.worst(reconcile.hash_verdict(), F.lit("DRIFT")))


@_query("""SELECT (SELECT count(*) FROM acct_source) AS source_rows, (SELECT count(*) FROM acct_stage) AS target_rows,
 (SELECT count(*) FROM acct_stage t WHERE t.acctnbr IS NULL OR NOT EXISTS (SELECT 1 FROM acct_source s WHERE s.batch_id = t.batch_id AND s.acctnbr = t.acctnbr)) AS orphans""")
def layer_boundary(spark, folder):
    return reconcile.boundary(_t(spark, folder, "acct_source"), _t(spark, folder, "acct_stage"), ["batch_id", "acctnbr"])


# Profiling ----------------------------------------------------------------------------------------


@_query("""WITH l AS (SELECT SourceName, greatest(0.0, (epoch_us(CompletedAt) - epoch_us(CAST(CycleDate + 1 AS TIMESTAMP))) / 86400000000.0) AS d FROM pipelineeventlog WHERE CompletedAt IS NOT NULL AND CycleDate IS NOT NULL)
SELECT SourceName, count(*) AS samples, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.9) AS p90, quantile_cont(d, 0.95) AS p95, quantile_cont(d, 0.99) AS p99,
 CASE WHEN count(*) >= 100 THEN 'HIGH' WHEN count(*) >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM l GROUP BY 1""")
def lateness_percentiles(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("CompletedAt IS NOT NULL AND CycleDate IS NOT NULL")
    return profiling.lateness(e.withColumn("d", profiling.lateness_days(F.col("CompletedAt"), F.col("CycleDate"))), ["SourceName"], "d")


@_query("""WITH m AS (SELECT TableName, CAST(floor(quantile_cont(DurationMs / 60000.0, 0.99)) AS BIGINT) AS l99_minutes, CAST(floor(quantile_cont(DurationMs / 30000.0, 0.99)) AS BIGINT) AS prior FROM pipelineeventlog GROUP BY 1)
SELECT TableName, l99_minutes, round((l99_minutes - prior) / nullif(prior, 0)::DOUBLE * 100, 2) AS drift_pct FROM m""")
def l99_drift(spark, folder):
    e = _t(spark, folder, "pipelineeventlog")
    now = profiling.p99_minutes(e.withColumn("m", F.col("DurationMs") / 60000.0), ["TableName"], "m")
    before = profiling.p99_minutes(e.withColumn("m", F.col("DurationMs") / 30000.0), ["TableName"], "m").select(F.col("TableName").alias("t"), F.col("l99_minutes").alias("p"))
    both = now.join(before, F.col("TableName").eqNullSafe(F.col("t")))
    return both.select("TableName", "l99_minutes", profiling.drift_percent(F.col("l99_minutes"), F.col("p")).alias("drift_pct"))


_AS_OF = "2026-02-20"
_BASE = f"""WITH r AS (SELECT *, dayofweek(CycleDate) = dayofweek(DATE '{_AS_OF}') AS same FROM pipelineeventlog WHERE EventType = 'EXTRACT' AND RowsProcessed IS NOT NULL AND CycleDate < DATE '{_AS_OF}' AND CycleDate >= DATE '{_AS_OF}' - 30),
m AS (SELECT *, count(*) FILTER (same) OVER (PARTITION BY TableName, SourceName) AS n FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY TableName, SourceName ORDER BY CycleDate DESC, EventLogId DESC, RowsProcessed DESC) AS rn FROM m WHERE same OR n < 2),
base AS (SELECT TableName, SourceName, CAST(floor(quantile_cont(RowsProcessed, 0.5)) AS BIGINT) AS baseline FROM k WHERE rn <= 14 GROUP BY 1, 2)
"""


def _baseline(spark: SparkSession, folder: str) -> DataFrame:
    e = _t(spark, folder, "pipelineeventlog").where("EventType = 'EXTRACT'")
    return profiling.weekday_baseline(e, ["TableName", "SourceName"], "CycleDate", "RowsProcessed", _AS_OF)


@_query(_BASE + "SELECT * FROM base")
def median_weekday_baseline(spark, folder):
    return _baseline(spark, folder)


@_query(_BASE + """, f AS (SELECT DISTINCT EventLogId, TableName, SourceName, RowsProcessed AS fresh FROM pipelineeventlog WHERE EventType = 'EXTRACT' AND RowsProcessed IS NOT NULL)
SELECT EventLogId, CASE WHEN baseline IS NULL OR baseline = 0 THEN CASE WHEN fresh > 100000000 THEN 'BLOCK_CEILING' ELSE 'OK' END WHEN fresh < floor(baseline * 0.1) THEN 'BLOCK_DROP'
 WHEN fresh > greatest(floor(baseline * 5.0), 1000) THEN 'BLOCK_GROWTH' WHEN fresh < floor(baseline * 0.5) THEN 'WARN' ELSE 'OK' END AS verdict
FROM f LEFT JOIN base ON f.TableName IS NOT DISTINCT FROM base.TableName AND f.SourceName IS NOT DISTINCT FROM base.SourceName""".replace("baseline = 0 THEN CASE WHEN fresh > 100000000", "baseline = 0 THEN CASE WHEN fresh > 1000"))
def extraction_guard(spark, folder):
    f = _t(spark, folder, "pipelineeventlog").where("EventType = 'EXTRACT' AND RowsProcessed IS NOT NULL").select("EventLogId", "TableName", "SourceName", F.col("RowsProcessed").alias("fresh")).distinct()
    b = _baseline(spark, folder).select(F.col("TableName").alias("t"), F.col("SourceName").alias("s"), "baseline")
    both = f.join(b, F.col("TableName").eqNullSafe(F.col("t")) & F.col("SourceName").eqNullSafe(F.col("s")), "left")
    return both.select("EventLogId", profiling.guard(F.col("fresh"), F.col("baseline"), F.lit(1000)).alias("verdict"))


_RUNS = "WITH r AS (SELECT DISTINCT TableName, SourceName, CycleDate AS day, Status = 'SUCCESS' AND coalesce(day(CycleDate) % 5 <> 0, true) AS ok FROM pipelineeventlog WHERE CycleDate IS NOT NULL AND TableName IS NOT NULL AND SourceName IS NOT NULL)"
_SPAN = _RUNS + ", sp AS (SELECT TableName, SourceName, min(day) AS first_day, DATE '2026-04-10' - 3 AS last_day FROM r GROUP BY 1, 2), cal AS (SELECT TableName, SourceName, first_day, last_day, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM sp), g AS (SELECT DISTINCT TableName, SourceName, day, true AS good FROM r WHERE ok)"


def _runs(spark: SparkSession, folder: str) -> tuple[DataFrame, object]:
    e = _t(spark, folder, "pipelineeventlog").where("CycleDate IS NOT NULL AND TableName IS NOT NULL AND SourceName IS NOT NULL")
    return e, (F.col("Status") == "SUCCESS") & (F.dayofmonth("CycleDate") % 5 != 0)


@_query(_SPAN + """SELECT TableName, SourceName, first_day, last_day, count(*) FILTER (good IS NULL) AS missing_days,
 CASE WHEN count(*) FILTER (good IS NULL) = 0 THEN 'NONE' WHEN count(good) > 0 THEN 'BACKFILL' ELSE 'INVESTIGATE' END AS action FROM cal LEFT JOIN g USING (TableName, SourceName, day) GROUP BY 1, 2, 3, 4""")
def gap_detect(spark, folder):
    runs, ok = _runs(spark, folder)
    return profiling.gaps(runs, ["TableName", "SourceName"], "CycleDate", ok, "2026-04-10", 3)


@_query(_SPAN + "SELECT TableName, SourceName, day FROM cal WHERE day <= DATE '2026-04-07' AND NOT EXISTS (SELECT 1 FROM g WHERE g.TableName = cal.TableName AND g.SourceName = cal.SourceName AND g.day = cal.day)")
def missing_days(spark, folder):
    runs, ok = _runs(spark, folder)
    return profiling.missing_days(runs, ["TableName", "SourceName"], "CycleDate", ok, "2026-04-07")


@_query(_RUNS + """, k AS (SELECT DISTINCT TableName, SourceName FROM r), p AS (SELECT TableName, SourceName, unnest([DATE '2026-01-10', DATE '2026-01-18']) AS a, unnest([DATE '2026-01-20', NULL]) AS b FROM k WHERE TableName = 'ACCT'),
rg AS (SELECT k.TableName, k.SourceName, CASE WHEN p.TableName IS NULL THEN DATE '2026-02-01' - 7 ELSE a END AS a, coalesce(b, DATE '2026-02-01') AS b FROM k LEFT JOIN p USING (TableName, SourceName)),
d AS (SELECT DISTINCT TableName, SourceName, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM rg), l AS (SELECT TableName, SourceName, max(day) AS last FROM r WHERE ok GROUP BY 1, 2)
SELECT TableName, SourceName, day, coalesce(day <= last, false) AS again FROM d LEFT JOIN l USING (TableName, SourceName)""")
def range_plan(spark, folder):
    runs, ok = _runs(spark, folder)
    keys = runs.where("TableName = 'ACCT'").select("TableName", "SourceName").distinct()
    a = keys.select("*", F.lit("2026-01-10").cast("date").alias("start_day"), F.lit("2026-01-20").cast("date").alias("end_day"))
    b = keys.select("*", F.lit("2026-01-18").cast("date").alias("start_day"), F.lit(None).cast("date").alias("end_day"))
    return profiling.plan_range(a.unionByName(b), runs, ["TableName", "SourceName"], "CycleDate", ok, "2026-02-01", 7)


@_query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS row_count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def capacity_growth(spark, folder):
    return profiling.monthly_growth(_t(spark, folder, "orders"), "o_orderdate")


@_query("""WITH m AS (SELECT avg(n) AS g FROM (SELECT count(*) AS n FROM orders GROUP BY date_trunc('month', o_orderdate)))
SELECT CAST(count(*) AS BIGINT) AS rows_now, CAST(count(*) + CAST(floor((SELECT g FROM m)) AS BIGINT) * 12 AS BIGINT) AS rows_then, CAST(floor((count(*) + CAST(floor((SELECT g FROM m)) AS BIGINT) * 12) * 200 / (1024.0 * 1024)) AS BIGINT) AS mb_then FROM orders""")
def capacity_projection(spark, folder):
    o = _t(spark, folder, "orders")
    g = profiling.monthly_growth(o, "o_orderdate").agg(F.floor(F.avg("row_count")).cast("bigint").alias("g"))
    n, mb = profiling.project(F.col("rows_now"), F.col("g"), 12, 200)
    return reconcile.one_row(o.agg(F.count("*").alias("rows_now")), g).select("rows_now", n.alias("rows_then"), mb.alias("mb_then"))


@_query("""SELECT TableName, SourceName, EventType, EventLogId, Status FROM (SELECT *, row_number() OVER (PARTITION BY TableName, SourceName, EventType ORDER BY StartedAt DESC NULLS LAST, EventLogId DESC NULLS LAST) AS rn FROM pipelineeventlog) WHERE rn = 1""")
def checkpoint_latest(spark, folder):
    out = profiling.latest_state(_t(spark, folder, "pipelineeventlog"), ["TableName", "SourceName", "EventType"], ["StartedAt", "EventLogId"])
    return out.select("TableName", "SourceName", "EventType", "EventLogId", "Status")


@_query("""SELECT TableName, SourceName, count(*) AS attempts, arg_max(coalesce(Status = 'SUCCESS', false), (StartedAt, EventLogId)) AS trusted, max(StartedAt) FILTER (Status = 'SUCCESS') AS last_good
FROM pipelineeventlog WHERE StartedAt IS NOT NULL GROUP BY 1, 2""")
def extraction_attempts(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("StartedAt IS NOT NULL")
    return profiling.attempts(e, ["TableName", "SourceName"], F.col("Status") == "SUCCESS", "StartedAt")


_STATES = ["created", "verified", "replicated", "archived", "replication_failed", "missing", "purged", "odd"]


@_query("""WITH s(a) AS (VALUES ('created'), ('verified'), ('replicated'), ('archived'), ('replication_failed'), ('missing'), ('purged'), ('odd')), l(a, b) AS (VALUES ('created', 'verified'), ('created', 'missing'), ('verified', 'replicated'),
 ('verified', 'replication_failed'), ('verified', 'missing'), ('replicated', 'archived'), ('replicated', 'missing'), ('archived', 'purged'), ('archived', 'missing'), ('replication_failed', 'replicated'), ('replication_failed', 'missing'))
SELECT x.a AS from_state, y.a AS to_state, EXISTS (SELECT 1 FROM l WHERE l.a = x.a AND l.b = y.a) AS legal FROM s x, s y""")
def snapshot_states(spark, folder):
    pairs = spark.createDataFrame([(a, b) for a in _STATES for b in _STATES], "from_state string, to_state string")
    return pairs.withColumn("legal", profiling.legal_transition(F.col("from_state"), F.col("to_state")))


_MODES = ["change_detect", "both", "parquet_snapshot", "odd"]


@_query("""WITH s(a) AS (VALUES ('change_detect'), ('both'), ('parquet_snapshot'), ('odd'))
SELECT x.a AS from_mode, y.a AS to_mode, CASE WHEN x.a = y.a THEN 'NOOP' WHEN x.a = 'odd' OR y.a = 'odd' THEN 'UNKNOWN' WHEN x.a = 'change_detect' AND y.a = 'parquet_snapshot' THEN 'RISKY' ELSE 'ALLOWED' END AS verdict FROM s x, s y""")
def mode_transitions(spark, folder):
    pairs = spark.createDataFrame([(a, b) for a in _MODES for b in _MODES], "from_mode string, to_mode string")
    return pairs.withColumn("verdict", profiling.mode_transition(F.col("from_mode"), F.col("to_mode")))


@_query("""SELECT BatchId, TableName, CASE WHEN datediff('day', CAST(StartedAt AS DATE), DATE '2026-05-01') >= 365 THEN 'frozen' WHEN datediff('day', CAST(StartedAt AS DATE), DATE '2026-05-01') >= 90 THEN 'cold'
 WHEN datediff('day', CAST(StartedAt AS DATE), DATE '2026-05-01') >= 30 THEN 'warm' ELSE 'hot' END AS tier FROM pipelineeventlog WHERE StartedAt IS NOT NULL""")
def tier_review(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("StartedAt IS NOT NULL")
    return e.select("BatchId", "TableName", profiling.tier_due(e, "StartedAt", "2026-05-01").alias("tier"))


@_query("""SELECT TableName, CASE WHEN avg(RowsProcessed) IS NULL THEN 'UNKNOWN' WHEN avg(RowsProcessed) < 3000 THEN 'COARSER' WHEN avg(RowsProcessed) > 8000 THEN 'FINER' ELSE 'KEEP' END AS advice FROM pipelineeventlog GROUP BY 1""")
def partition_advice(spark, folder):
    per = _t(spark, folder, "pipelineeventlog").groupBy("TableName").agg(F.avg("RowsProcessed").alias("mb"))
    return per.select("TableName", profiling.partition_advice(F.col("mb"), 3000, 8000).alias("advice"))


@_query("SELECT count(*) AS versions, count(*) FILTER (UdmActiveFlag = 1) AS active, count(*) FILTER (UdmActiveFlag = 1) / count(*) AS ratio FROM pers_bronze")
def active_ratio(spark, folder):
    return profiling.active_ratio(_t(spark, folder, "pers_bronze"))


@_query("""SELECT max(UdmEffectiveDateTime) AS latest, (epoch_us(TIMESTAMP '2026-01-01') - epoch_us(max(UdmEffectiveDateTime))) / 3600000000.0 AS age_hours,
 CASE WHEN (epoch_us(TIMESTAMP '2026-01-01') - epoch_us(max(UdmEffectiveDateTime))) / 3600000000.0 > 48 THEN 'ERROR' WHEN (epoch_us(TIMESTAMP '2026-01-01') - epoch_us(max(UdmEffectiveDateTime))) / 3600000000.0 > 36 THEN 'WARN' ELSE 'OK' END AS level FROM pers_bronze""")
def freshness(spark, folder):
    return profiling.freshness(_t(spark, folder, "pers_bronze"), "2026-01-01")


@_query("""SELECT BatchId, CASE WHEN SourceRows = 0 THEN TargetRows = 0 ELSE abs(TargetRows - SourceRows) <= SourceRows * 0.005 END AS within FROM reconciliationlog""")
def source_count_check(spark, folder):
    log = _t(spark, folder, "reconciliationlog")
    return log.select("BatchId", profiling.count_within(F.col("TargetRows"), F.col("SourceRows")).alias("within"))


@_query("""SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment']) AS column_name, unnest([count(DISTINCT c_custkey) = count(*) AND count(c_custkey) = count(*), count(DISTINCT c_name) = count(*) AND count(c_name) = count(*),
 count(DISTINCT c_nationkey) = count(*) AND count(c_nationkey) = count(*), count(DISTINCT c_mktsegment) = count(*) AND count(c_mktsegment) = count(*)]) AS is_key FROM customer""")
def candidate_keys(spark, folder):
    return profiling.candidate_keys(_t(spark, folder, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


@_query("SELECT min(opendate) AS smallest, max(opendate) AS largest, count(*) FILTER (opendate IS NULL) AS missing FROM acct_source")
def partition_skew(spark, folder):
    return profiling.partition_skew(_t(spark, folder, "acct_source"), "opendate")


@_query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL")
def distinct_days(spark, folder):
    return readers.distinct_days(_t(spark, folder, "events"), "ts")


@_query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-11'")
def windowed_extract(spark, folder):
    from datetime import date

    return readers.window(_t(spark, folder, "events"), "ts", date(2024, 1, 10), 1440).select("event_id")


@_query("SELECT Status, EventType, count(*) AS n FROM pipelineeventlog WHERE StartedAt < TIMESTAMP '2026-03-01' GROUP BY 1, 2")
def log_cohorts(spark, folder):
    return _t(spark, folder, "pipelineeventlog").where(F.col("StartedAt") < F.lit("2026-03-01").cast("timestamp_ntz")).groupBy("Status", "EventType").agg(F.count("*").alias("n"))


@_query("""SELECT acctnbr, count(*) FILTER (_cdc_operation = 'I') AS inserts, count(*) FILTER (_cdc_operation = 'U') AS updates FROM acct_change WHERE acctnbr IS NOT NULL GROUP BY 1
HAVING count(*) FILTER (_cdc_operation = 'I') > 1 ORDER BY inserts DESC, updates DESC, acctnbr LIMIT 10""")
def churn_rank(spark, folder):
    return profiling.churn(_t(spark, folder, "acct_change"), ["acctnbr"])


@_query("""SELECT QuarantineId, 'ACCT' AS TableName, '{"QuarantineId":' || CAST(QuarantineId AS VARCHAR) || ',"BatchId":' || CAST(BatchId AS VARCHAR) || '}' AS RecordData FROM quarantine WHERE BatchId IS NOT NULL""")
def quarantine_records(spark, folder):
    q = _t(spark, folder, "quarantine").where("BatchId IS NOT NULL").select("QuarantineId", "BatchId")
    out = sinks.quarantine(q, "checked", "ACCT", "FILES", 1, "2026-01-01")
    return out.select(F.get_json_object("RecordData", "$.QuarantineId").cast("bigint").alias("QuarantineId"), "TableName", "RecordData")
