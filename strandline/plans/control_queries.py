"""Queries of control tables, sources, samples and guards, each beside the SQL that gives the same rows.

They are added to the registry of :mod:`reference_queries`.  The small tables that an operator needs and the test
data lack (a registry, a vault, a configuration) are derived from the event log, the persons and the layout.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import add_row_hash, rewrite_strings
from ..operators import cdc, cleaning, control, integrity, profiling, reconcile, scd2
from ..sources import readers, sinks, snapshots
from .reference_queries import QUERIES, SQL, _ACCT, _LAST, _ORDERS, _DAYS, _accounts_as_bronze, _double_text, _existing, _fresh, _load, _query, _string_text, _t
from .storage import new_path

__all__ = ["QUERIES", "SQL"]


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Guards -------------------------------------------------------------------------------------------


@_query("SELECT o_orderkey, 'S' AS change FROM orders WHERE false")
def cdc_empty_arrival(spark, folder):
    return cdc.classify(_existing(spark, folder), _fresh(spark, folder).limit(0), ["o_orderkey"])


@_query(_ORDERS + "SELECT (SELECT count(*) FROM f) AS arrived, count(*) FILTER (change <> 'D') AS classified, (SELECT count(*) FROM f) = count(*) FILTER (change <> 'D') AS holds FROM c")
def cdc_counts_hold(spark, folder):
    return cdc.counts_hold(cdc.classify(_existing(spark, folder), _fresh(spark, folder), ["o_orderkey"]), _fresh(spark, folder))


@_query(_ORDERS + "SELECT o_orderkey, o_orderkey % 14 = 0 AS still_there FROM c WHERE change = 'D'")
def cdc_split_deletes(spark, folder):
    still = _t(spark, folder, "orders").where("o_orderkey % 14 = 0")
    return cdc.split_deletes(cdc.classify(_existing(spark, folder), _fresh(spark, folder), ["o_orderkey"]), still, ["o_orderkey"])


@_query("SELECT l_orderkey, l_linenumber, 'D' AS change FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WHERE l_linenumber % 2 = 1")
def cdc_many_deletes_verified(spark, folder):
    """Every line is about to be deleted; those with an even number are still at the source."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = _t(spark, folder, "lineitem").select(*keys).distinct()
    return cdc.verify_deletes(lines.withColumn("change", F.lit("D")), _t(spark, folder, "lineitem").where("l_linenumber % 2 = 0"), keys)


@_query("SELECT c_custkey, CAST(1 AS TINYINT) AS flag FROM customer WHERE c_custkey % 17 <> 0")
def scd2_empty_arrival(spark, folder):
    first = scd2.first_load(_load(spark, folder, 1), ["c_custkey"], _DAYS[0])
    return scd2.apply(first, _load(spark, folder, 2).limit(0), ["c_custkey"], _DAYS[1]).select("c_custkey", F.col("UdmActiveFlag").alias("flag"))


@_query("""SELECT c_custkey, CAST(CASE WHEN c_custkey % 22 = 0 THEN 2 WHEN c_custkey % 5 = 0 AND c_custkey % 11 <> 0 THEN 0 ELSE 1 END AS TINYINT) AS flag FROM customer WHERE c_custkey % 17 <> 0
UNION ALL SELECT c_custkey, CAST(1 AS TINYINT) FROM customer WHERE c_custkey % 11 <> 0 AND (c_custkey % 17 = 0 OR c_custkey % 5 = 0)""")
def scd2_verifier(spark, folder):
    """Of the customers that are gone only the even ones are confirmed to be."""
    first = scd2.first_load(_load(spark, folder, 1), ["c_custkey"], _DAYS[0])
    out = scd2.apply(first, _load(spark, folder, 2), ["c_custkey"], _DAYS[1], verifier=lambda gone: gone.where("c_custkey % 2 = 0"))
    return out.select("c_custkey", F.col("UdmActiveFlag").alias("flag"))


@_query("""WITH n AS (SELECT count(*) FILTER (c_custkey % 17 <> 0) + count(*) FILTER (c_custkey % 11 <> 0 AND (c_custkey % 17 = 0 OR c_custkey % 5 = 0)) AS n FROM customer)
SELECT n AS versions, n AS distinct_keys, CAST(1 AS BIGINT) AS first_key, CAST(n AS BIGINT) AS last_key FROM n""")
def scd2_surrogate(spark, folder):
    first = scd2.first_load(_load(spark, folder, 1), ["c_custkey"], _DAYS[0], surrogate="_scd2_key")
    out = scd2.apply(first, _load(spark, folder, 2), ["c_custkey"], _DAYS[1], surrogate="_scd2_key")
    k = F.col("_scd2_key")
    return out.agg(F.count("*").alias("versions"), F.count_distinct(k).alias("distinct_keys"), F.min(k).alias("first_key"), F.max(k).alias("last_key"))


@_query("""SELECT c_custkey, CAST(CASE WHEN c_custkey % 44 = 0 THEN 2 WHEN c_custkey % 5 = 0 AND c_custkey % 11 <> 0 AND c_custkey % 4 = 0 THEN 0 ELSE 1 END AS TINYINT) AS flag FROM customer WHERE c_custkey % 17 <> 0
UNION ALL SELECT c_custkey, CAST(1 AS TINYINT) FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 4 = 0 AND (c_custkey % 17 = 0 OR c_custkey % 5 = 0)""")
def scd2_targeted_store(spark, folder):
    """A targeted arrival on a history in buckets."""
    store = scd2.HistoryStore(spark, ["c_custkey"], 4).write(scd2.first_load(_load(spark, folder, 1), ["c_custkey"], _DAYS[0]))
    gone = _t(spark, folder, "customer").where("c_custkey % 44 = 0")
    new = store.apply_targeted(_load(spark, folder, 2).where("c_custkey % 4 = 0"), gone, _DAYS[1])
    return new.read().select("c_custkey", F.col("UdmActiveFlag").alias("flag"))


# Cleaning -----------------------------------------------------------------------------------------


@_query("SELECT persnbr, TIMESTAMP '2026-01-01' AS _extracted_at FROM pers_bronze")
def extracted_at(spark, folder):
    return cleaning.add_extracted_at(_t(spark, folder, "pers_bronze").select("persnbr"), "2026-01-01")


@_query("SELECT batch_id, acctnbr, rtrim(nfc_normalize(acctname), ' ') AS acctname, rtrim(nfc_normalize(note), ' ') AS note FROM acct_source")
def hashed_rewrite(spark, folder):
    return rewrite_strings(_t(spark, folder, "acct_source").select("batch_id", "acctnbr", "acctname", "note"))


@_query("""SELECT coalesce(CAST(l_orderkey AS VARCHAR), '') || '|' || coalesce(CAST(l_linenumber AS VARCHAR), '') AS key_text, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_key_samples(spark, folder):
    keys = ["l_orderkey", "l_linenumber"]
    return cleaning.duplicate_keys(_t(spark, folder, "lineitem"), keys).select(cleaning.key_literal(keys).alias("key_text"), "n")


@_query("SELECT batch_id, acctnbr FROM acct_source UNION SELECT batch_id, acctnbr FROM acct_stage")
def union_of_keys(spark, folder):
    return cleaning.union_of_keys([_t(spark, folder, n) for n in ("acct_source", "acct_stage")], ["batch_id", "acctnbr"])


_CLEAN = "'[\\t\\n\\r\\x00\\x0B\\x0C\\x{85}\\x{2028}\\x{2029}]'"


@_query(f"""WITH r AS (SELECT batch_id, acctnbr, rtrim(nfc_normalize(acctname), ' ') AS acctname, rtrim(nfc_normalize(note), ' ') AS note, curbal, batch_id % 2 = 0 AS even FROM acct_source)
SELECT batch_id, acctnbr, regexp_replace(acctname, {_CLEAN}, '', 'g') AS acctname, regexp_replace(note, {_CLEAN}, '', 'g') AS note, CAST(even AS TINYINT) AS even, TIMESTAMP '2026-01-01' AS _extracted_at,
  sha256(concat_ws(chr(31), {_string_text('acctname')}, {_string_text('note')}, {_double_text('curbal')}, coalesce(CAST(CAST(even AS TINYINT) AS VARCHAR), chr(31) || 'NULL' || chr(31)))) AS _row_hash FROM r""")
def prepared(spark, folder):
    """The whole preparation of an extract: strings, hash, time, control characters, booleans."""
    df = _t(spark, folder, "acct_source").select("batch_id", "acctnbr", "acctname", "note", "curbal", (F.col("batch_id") % 2 == 0).alias("even"))
    return sinks.prepare(df, "2026-01-01", exclude=["batch_id", "acctnbr"], portable=True).drop("curbal")


@_query("""WITH p AS (SELECT persnbr, CASE WHEN persnbr % 2 = 0 THEN 'active' ELSE 'revoked' END AS st, persname FROM pers_bronze)
SELECT persnbr, CASE WHEN persname IN (SELECT persname FROM p WHERE st = 'active' AND persname IS NOT NULL) THEN persname END AS persname FROM p""")
def detokenise_active(spark, folder):
    """Only tokens of the names that an even person has are active."""
    b = _t(spark, folder, "pers_bronze").select("persnbr", "persname")
    even = cleaning.token_map(b.where("persnbr % 2 = 0"), ["persname"], "k", "NAME").withColumn("Status", F.lit("active"))
    odd = cleaning.token_map(b, ["persname"], "k", "NAME").join(even.select("token"), "token", "left_anti").withColumn("Status", F.lit("revoked"))
    return cleaning.detokenise(cleaning.tokenise(b, ["persname"], "k", "NAME"), "persname", even.unionByName(odd), ["active"])


@_query("""WITH o AS (SELECT DISTINCT persname FROM pers_bronze WHERE persname IS NOT NULL AND UdmActiveFlag = 1), a AS (SELECT DISTINCT persname FROM pers_bronze WHERE persname IS NOT NULL)
SELECT count(*) FILTER (o.persname IS NOT NULL) AS reused, count(*) FILTER (o.persname IS NULL) AS "new" FROM a LEFT JOIN o USING (persname)""")
def token_use(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    before, now = (cleaning.token_map(x, ["persname"], "k", "NAME") for x in (b.where("UdmActiveFlag = 1"), b))
    return cleaning.token_use(before, now)


@_query(r"""SELECT doc_id, regexp_replace(regexp_replace('passphrase: ' || text || chr(10) || '-----BEGIN RSA PRIVATE KEY-----' || chr(10) || 'abc' || chr(10) || '-----END RSA PRIVATE KEY-----',
  '(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----', '***', 'g'), '(?i)passphrase\s*[=:]\s*\S+', 'passphrase=***', 'g') AS text FROM documents""")
def redact_keys(spark, folder):
    block = "\n-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----"
    text = F.concat(F.lit("passphrase: "), "text", F.lit(block))
    return _t(spark, folder, "documents").select("doc_id", cleaning.redact(text).alias("text"))


@_query("SELECT count(*) FILTER (o_orderdate IS NOT NULL) AS parsed, count(*) AS filled, true AS is_time FROM orders WHERE o_orderdate IS NOT NULL")
def time_columns_found(spark, folder):
    o = _t(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return cleaning.looks_like_times(o, "day")


# Sources ------------------------------------------------------------------------------------------


@_query("SELECT c_custkey, c_name FROM customer")
def full_scan(spark, folder):
    return readers.read(spark, readers.FileSource(f"{folder}/customer.parquet", select=("c_custkey", "c_name")))


@_query("SELECT CAST(n_nationkey AS VARCHAR) AS nation_key, n_name || chr(10) || 'second \"line\"' AS name, CAST(n_regionkey AS VARCHAR) AS region_key FROM nation")
def csv_between_rows(spark, folder):
    """Lines before the header, a record after it, quoted line breaks: as a file has them."""
    path = new_path(spark, "csv")
    n = _t(spark, folder, "nation")
    body = n.select(F.concat(F.col("n_nationkey"), F.lit(';"'), "n_name", F.lit('\nsecond ""line"""'), F.lit(";"), F.col("n_regionkey")).alias("value"))
    head = spark.createDataFrame([('made by "us"',), ("",), ("nation_key;name;region_key",), ("number;;number",)], "value string")
    head.coalesce(1).unionByName(body).coalesce(1).write.text(path)
    return readers.read(spark, readers.FileSource(path, "csv", ";", skip_rows=2, skip_after=1))


@_query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def json_lines(spark, folder):
    path = new_path(spark, "json")
    _t(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.json(path)
    schema = _t(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey").schema
    return readers.read(spark, readers.FileSource(path, "ndjson", schema=schema))


@_query("SELECT CAST(count(*) AS BIGINT) AS snapshot_rows, CAST(count(*) AS BIGINT) AS active_rows, count(*) FILTER (c_custkey % 5 = 0) AS changed_rows FROM customer WHERE c_custkey % 11 <> 0")
def replay_smoke(spark, folder):
    """A snapshot is written, verified and replayed into a history, whose counts must fit it."""
    root = new_path(spark, "snapshots")
    snap = snapshots.Snapshot(root, "S", "CUSTOMER", date(2026, 2, 1), 2)
    snapshots.write_snapshot(_load(spark, folder, 2), snap)
    rows = snapshots.replay(spark, snap)
    base = add_row_hash(_t(spark, folder, "customer").where("c_custkey % 11 <> 0").select("c_custkey", "c_acctbal", "c_mktsegment"), portable=True)
    out = scd2.apply(scd2.first_load(base, ["c_custkey"], _DAYS[0]), rows, ["c_custkey"], _DAYS[1])
    return cleaning.one_row(
        rows.agg(F.count("*").alias("snapshot_rows")), out.agg(F.count_if(F.col("UdmActiveFlag") == 1).alias("active_rows"), F.count_if(F.col("UdmActiveFlag") == 0).alias("changed_rows"))
    )


_REGISTRY = """WITH r AS (SELECT SourceName, TableName, CycleDate, BatchId, EventLogId, 'p' || EventLogId AS Path, RowsProcessed AS RowCount, 'h' || EventLogId AS Sha256,
  CASE WHEN Status = 'SUCCESS' THEN 'created' WHEN Status = 'SKIPPED' THEN 'verified' ELSE lower(Status) END AS Status, StartedAt AS CreatedAt
  FROM (SELECT DISTINCT ON (EventLogId) * FROM pipelineeventlog WHERE EventLogId IS NOT NULL ORDER BY EventLogId) WHERE EventType = 'EXTRACT')
"""


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    e = _t(spark, folder, "pipelineeventlog").where("EventLogId IS NOT NULL").dropDuplicates(["EventLogId"]).where("EventType = 'EXTRACT'")
    state = F.when(F.col("Status") == "SUCCESS", "created").when(F.col("Status") == "SKIPPED", "verified").otherwise(F.lower("Status"))
    path, digest = (F.concat(F.lit(x), F.col("EventLogId").cast("string")) for x in "ph")
    return e.select(
        "SourceName", "TableName", F.col("CycleDate").alias("BusinessDate"), "BatchId", "EventLogId", path.alias("Path"), F.col("RowsProcessed").alias("RowCount"), digest.alias("Sha256"), state.alias("Status"), F.col("StartedAt").alias("CreatedAt"),
    )


def _verified(spark: SparkSession, folder: str) -> DataFrame:
    r = _registry(spark, folder)
    n = F.col("EventLogId")
    found = r.where(n % 7 != 0).select("Path", F.when(n % 5 == 0, "other").otherwise(F.col("Sha256")).alias("Sha256"), F.col("RowCount").alias("Rows"))
    return snapshots.mark_verified(r, found)


_VERDICT = """, v AS (SELECT *, CASE WHEN Status = 'verified' THEN 'skipped' WHEN Status IS DISTINCT FROM 'created' THEN 'status_invalid' WHEN EventLogId % 7 = 0 THEN 'missing'
  WHEN EventLogId % 5 = 0 THEN 'hash_mismatch' ELSE 'verified' END AS verdict FROM r)
"""


@_query(_REGISTRY + _VERDICT + "SELECT EventLogId, verdict, CASE WHEN verdict = 'verified' THEN 'verified' ELSE Status END AS Status FROM v")
def registry_verify(spark, folder):
    return _verified(spark, folder).select("EventLogId", "verdict", "Status")


@_query(_REGISTRY + _VERDICT + """SELECT verdict, count(*) AS n FROM v GROUP BY 1
UNION ALL SELECT 'failed', count(*) FROM v WHERE verdict IN ('missing', 'hash_mismatch', 'status_invalid', 'error')""")
def registry_verdict_counts(spark, folder):
    return snapshots.verdict_counts(_verified(spark, folder))


@_query(_REGISTRY + "SELECT EventLogId, Path FROM r WHERE SourceName = 'DNA' AND TableName = 'ACCT' AND CycleDate = DATE '2026-01-05' AND BatchId = 41000")
def registry_lookup(spark, folder):
    return snapshots.lookup(_registry(spark, folder), "DNA", "ACCT", "2026-01-05", 41000).select("EventLogId", "Path")


@_query(_REGISTRY + """SELECT SourceName, TableName, CycleDate AS BusinessDate, EventLogId FROM (SELECT *, row_number() OVER (PARTITION BY SourceName, TableName, CycleDate ORDER BY CreatedAt DESC, BatchId DESC) AS rn FROM r
  WHERE Status IN ('verified', 'replicated', 'archived', 'replication_failed')) WHERE rn = 1""")
def registry_latest(spark, folder):
    return snapshots.latest_for_date(_registry(spark, folder)).select("SourceName", "TableName", "BusinessDate", "EventLogId")


# Control tables -----------------------------------------------------------------------------------

_EVENTS = """WITH e AS (SELECT *, floor((epoch_us(CompletedAt) - epoch_us(StartedAt)) / 1000)::BIGINT AS ms FROM pipelineeventlog)
"""


@_query(_EVENTS + """SELECT EventLogId, BatchId, CASE WHEN ErrorMessage IS NOT NULL THEN 'FAILED' WHEN Status IN ('FAILED', 'SKIPPED') THEN Status ELSE 'SUCCESS' END AS Status, ms AS DurationMs,
  CASE WHEN ms > 0 AND RowsProcessed > 0 THEN ((RowsProcessed * 200000 + ms) // (2 * ms)) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS RowsPerSecond FROM e""")
def event_rows(spark, folder):
    return control.finish_events(_t(spark, folder, "pipelineeventlog")).select("EventLogId", "BatchId", "Status", "DurationMs", "RowsPerSecond")


@_query("""SELECT EventLogId, BatchId, name, json_extract_string(Metadata, '$."' || name || '"') AS value FROM (SELECT EventLogId, BatchId, Metadata, unnest(json_keys(Metadata)) AS name FROM pipelineeventlog WHERE json_valid(Metadata))
UNION ALL SELECT EventLogId, BatchId, CAST(i AS VARCHAR), CASE i WHEN 0 THEN CAST(BatchId AS VARCHAR) ELSE EventType END FROM pipelineeventlog, (VALUES (0), (1)) v(i) WHERE BatchId IS NOT NULL AND EventType IS NOT NULL""")
def metadata_entries(spark, folder):
    """Entries of the events' metadata, and of lists made of two of their columns."""
    e = _t(spark, folder, "pipelineeventlog")
    lists = e.where("BatchId IS NOT NULL AND EventType IS NOT NULL").select("EventLogId", "BatchId", F.to_json(F.array(F.col("BatchId").cast("string"), "EventType")).alias("Metadata"))
    return control.config_entries(e.select("EventLogId", "BatchId", "Metadata").unionByName(lists), ["EventLogId", "BatchId"], "Metadata")


_TRIES = """WITH d AS (SELECT DISTINCT EventLogId, TableName, SourceName, CycleDate, StartedAt FROM pipelineeventlog WHERE EventType = 'EXTRACT'),
l AS (SELECT *, row_number() OVER (PARTITION BY TableName, SourceName ORDER BY StartedAt, EventLogId) AS Attempt FROM d WHERE CycleDate < DATE '2026-03-01')
"""


@_query(_TRIES + """SELECT EventLogId, CAST(Attempt AS INTEGER) AS Attempt FROM l UNION ALL SELECT d.EventLogId, CAST(coalesce(m.n, 0) + row_number() OVER (PARTITION BY d.TableName, d.SourceName ORDER BY d.StartedAt, d.EventLogId) AS INTEGER)
FROM d LEFT JOIN (SELECT TableName, SourceName, max(Attempt) AS n FROM l GROUP BY 1, 2) m ON m.TableName = d.TableName AND m.SourceName = d.SourceName WHERE CycleDate >= DATE '2026-03-01'""")
def attempts_recorded(spark, folder):
    d = _t(spark, folder, "pipelineeventlog").where("EventType = 'EXTRACT'").select("EventLogId", "TableName", "SourceName", "CycleDate", "StartedAt").distinct()
    keys, early = ["TableName", "SourceName"], F.col("CycleDate") < F.lit("2026-03-01").cast("date")
    empty = d.limit(0).withColumn("Attempt", F.lit(0))
    log = control.record_attempts(empty, d.where(early), keys, "StartedAt", "EventLogId")
    return control.record_attempts(log, d.where(~early), keys, "StartedAt", "EventLogId").select("EventLogId", "Attempt")


@_query("""SELECT EventLogId FROM pipelineeventlog WHERE NOT coalesce(Status IN ('IN_PROGRESS', 'SUCCESS', 'FAILED'), false) OR NOT coalesce(BatchId > 0, false) OR coalesce(TableName, '') = '' OR coalesce(SourceName, '') = '' OR CycleDate IS NULL""")
def attempts_refused(spark, folder):
    return control.bad_attempts(_t(spark, folder, "pipelineeventlog")).select("EventLogId")


_STEPS = ["BatchId", "TableName", "SourceName", "EventType"]
_LEDGER = """WITH g AS (SELECT BatchId, TableName, SourceName, EventType, StartedAt, CASE WHEN Status = 'SUCCESS' THEN 'COMPLETED' ELSE Status END AS Status FROM (SELECT *, row_number() OVER (PARTITION BY BatchId, TableName, SourceName, EventType
  ORDER BY EventLogId DESC, StartedAt DESC) AS rn FROM pipelineeventlog WHERE BatchId IS NOT NULL AND TableName IS NOT NULL AND SourceName IS NOT NULL AND EventType IS NOT NULL) WHERE rn = 1)
"""


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    e = _t(spark, folder, "pipelineeventlog").where(" AND ".join(f"{k} IS NOT NULL" for k in _STEPS))
    last = cleaning.keep_first(e, _STEPS, [F.desc("EventLogId"), F.desc("StartedAt")])
    return last.select(*_STEPS, "StartedAt", F.when(F.col("Status") == "SUCCESS", "COMPLETED").otherwise(F.col("Status")).alias("Status"), "CompletedAt", "ErrorMessage")


@_query(_LEDGER + """, w AS (SELECT DISTINCT BatchId + CASE WHEN BatchId % 3 = 0 THEN 1000000 ELSE 0 END AS BatchId, TableName, SourceName, EventType FROM g)
SELECT w.*, CASE WHEN g.BatchId IS NULL THEN 'RUN' WHEN Status = 'COMPLETED' THEN 'SKIP' WHEN Status = 'IN_PROGRESS' THEN 'BUSY' WHEN Status = 'FAILED' THEN 'RETRY' ELSE 'UNKNOWN' END AS decision FROM w LEFT JOIN g USING (BatchId, TableName, SourceName, EventType)""")
def ledger_gate(spark, folder):
    g = _ledger(spark, folder)
    wanted = g.withColumn("BatchId", F.col("BatchId") + F.when(F.col("BatchId") % 3 == 0, 1_000_000).otherwise(0))
    return control.ledger_gate(g, wanted, _STEPS)


@_query(_LEDGER + """SELECT BatchId, TableName, SourceName, EventType, CASE WHEN stale THEN 'FAILED' ELSE Status END AS Status, CASE WHEN stale THEN 'SWEPT' END AS RecoveryAction
FROM (SELECT *, Status = 'IN_PROGRESS' AND StartedAt < TIMESTAMP '2026-06-01' - INTERVAL 60 MINUTE AND EventType <> 'TABLE_TOTAL' AS stale FROM g)""")
def ledger_sweep(spark, folder):
    out = control.ledger_sweep(_ledger(spark, folder), "2026-06-01", 60, 1000, ["TABLE_TOTAL"])
    return out.select(*_STEPS, "Status", "RecoveryAction")


@_query(_LEDGER + "SELECT BatchId, TableName, SourceName, EventType, CASE WHEN Status = 'IN_PROGRESS' THEN 'COMPLETED' ELSE Status END AS Status FROM g")
def ledger_finish(spark, folder):
    g = _ledger(spark, folder)
    done = g.where("Status = 'IN_PROGRESS'").select(*_STEPS, F.lit("COMPLETED").alias("Status"), _ts("2026-06-01").alias("CompletedAt"), F.lit(None).cast("string").alias("ErrorMessage"))
    twice = done.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    return control.ledger_finish(g, twice, _STEPS).select(*_STEPS, "Status")


def _columns(spark: SparkSession, folder: str) -> DataFrame:
    return _t(spark, folder, "file_layout").select(F.lit("FILES").alias("SourceName"), F.col("table_name").alias("TableName"), F.col("column_name").alias("ColumnName"))


_PROFILE = [("FILES", "SCD2DateColumns", "txntime", 1, 2), ("FILES", "SCD2DateColumns", "opendate", 2, 2), ("FILES", "SCD2DateColumns", "since", 3, 2), ("FILES", "SCD2DateColumns", "changed", 4, 2), ("FILES", "SCD2DateColumns", "birthdate", 5, 2),
            ("*", "ExcludeFromHash", "note", 1, 3), ("*", "ExcludeFromHash", "remark", 2, 3), ("*", "SCD2DateColumns", "acctnbr", 1, 1), ("OTHER", "ExcludeFromHash", "city", 1, 1)]


@_query("""SELECT 'FILES' AS SourceName, t AS TableName, f AS FieldName, v AS ProposedValue FROM (VALUES ('ACCT', 'SCD2DateColumns', 'opendate'), ('CARDTXN', 'SCD2DateColumns', 'txntime'), ('PERS', 'SCD2DateColumns', 'changed,birthdate'),
  ('ORG', 'SCD2DateColumns', 'since'), ('ACCT', 'ExcludeFromHash', 'note'), ('ORG', 'ExcludeFromHash', 'remark')) x(t, f, v)""")
def config_proposal(spark, folder):
    profiles = spark.createDataFrame(_PROFILE, "SourceName string, FieldName string, ColumnName string, Priority int, Most int")
    return control.propose_config(_columns(spark, folder), profiles)


@_query("""WITH t AS (SELECT table_name AS TableName, count(*) AS n FROM file_layout GROUP BY 1)
SELECT 'FILES' AS SourceName, TableName, CASE WHEN n > 5 THEN 'a' || n ELSE 'old' END AS ExcludeFromHash, CASE WHEN TableName = 'ORG' THEN 'b' ELSE 'old' END AS SCD2DateColumns FROM t""")
def config_approved(spark, folder):
    t = _t(spark, folder, "file_layout").groupBy(F.col("table_name").alias("TableName")).agg(F.count("*").alias("n")).withColumn("SourceName", F.lit("FILES"))
    config = t.select("SourceName", "TableName", F.lit("old").alias("ExcludeFromHash"), F.lit("old").alias("SCD2DateColumns"))
    never, done = F.lit(None).cast("timestamp_ntz"), _ts("2026-01-01")

    def rows(where, number, name, value, status, applied):
        return t.where(where).select(number.cast("bigint").alias("ProposalId"), "SourceName", "TableName", F.lit(name).alias("FieldName"), value.alias("ProposedValue"), F.lit(status).alias("Status"), applied.alias("AppliedAt"))

    approved = rows("n > 5", F.lit(2), "ExcludeFromHash", F.concat(F.lit("a"), F.col("n").cast("string")), "APPROVED", never)
    parts = [
        rows("n > 5", F.lit(1), "ExcludeFromHash", F.lit("earlier"), "APPROVED", never), rows("TableName = 'ORG'", F.lit(3), "SCD2DateColumns", F.lit("b"), "APPROVED", never),
        rows("n > 0", F.lit(4), "SCD2DateColumns", F.lit("c"), "PENDING", never), rows("n > 0", F.lit(5), "SCD2DateColumns", F.lit("d"), "APPROVED", done), rows("n > 0", F.lit(6), "Unknown", F.lit("e"), "APPROVED", never),
    ]
    for p in parts:
        approved = approved.unionByName(p)
    return control.apply_approved(config, approved, ["ExcludeFromHash", "SCD2DateColumns"], "2026-06-01")[0]


@_query("""WITH a AS (SELECT table_name, column_name, lower(value_type) AS stored_type FROM file_layout WHERE column_name <> 'note'),
b AS (SELECT table_name, column_name, CASE WHEN value_type = 'decimal(12,2)' THEN 'decimal(12,4)' WHEN value_type = 'string(40)' THEN 'string(60)' WHEN value_type = 'string(50)' THEN 'string(20)' WHEN value_type = 'date' THEN 'timestamp'
  ELSE value_type END AS now_type FROM file_layout WHERE column_name <> 'city')
SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.column_name, b.column_name) AS column_name, stored_type, now_type, CASE WHEN stored_type IS NULL THEN 'ADDED' WHEN now_type IS NULL THEN 'REMOVED'
  WHEN stored_type = 'date' THEN 'RETYPED' WHEN stored_type = 'string(40)' THEN 'WIDENED' ELSE 'NARROWED' END AS drift
FROM a FULL JOIN b ON a.table_name = b.table_name AND a.column_name = b.column_name WHERE stored_type IS DISTINCT FROM now_type""")
def type_drift(spark, folder):
    layout = _t(spark, folder, "file_layout").select("table_name", "column_name", "value_type")
    v = F.col("value_type")
    now = F.when(v == "decimal(12,2)", "decimal(12,4)").when(v == "string(40)", "string(60)").when(v == "string(50)", "string(20)").when(v == "date", "timestamp").otherwise(v)
    return control.type_drift(layout.where("column_name <> 'note'"), layout.where("column_name <> 'city'").withColumn("value_type", now))


@_query("""WITH k AS (SELECT DISTINCT batch_id, acctnbr, 1 AS s FROM acct_source WHERE acctnbr IS NOT NULL), t AS (SELECT DISTINCT batch_id, acctnbr, 1 AS s FROM acct_stage WHERE acctnbr IS NOT NULL),
c AS (SELECT count(*) FILTER (t.s IS NULL) AS so, count(*) FILTER (k.s IS NULL) AS tgt FROM k FULL JOIN t ON k.batch_id = t.batch_id AND k.acctnbr = t.acctnbr)
SELECT 'ACCT' AS TableName, 'ACTIVE_KEYS' AS CheckType, CASE WHEN so = 0 AND tgt = 0 THEN 'PASSED' ELSE 'FAILED' END AS Status, CAST(so AS BIGINT) AS SourceOnlyRows, CAST(tgt AS BIGINT) AS TargetOnlyRows, CAST(0 AS BIGINT) AS MismatchedRows FROM c""")
def results_persisted(spark, folder):
    """The outcome of a comparison, stored in the log of reconciliations and read back."""
    s, t = (_t(spark, folder, n).where("acctnbr IS NOT NULL") for n in ("acct_source", "acct_stage"))
    found = reconcile.ghost_keys(s, t, ["batch_id", "acctnbr"]).withColumnsRenamed({"missing": "SourceOnlyRows", "ghosts": "TargetOnlyRows"})
    clean = (F.col("SourceOnlyRows") == 0) & (F.col("TargetOnlyRows") == 0)
    path = new_path(spark, "results")
    sinks.append(control.result_rows(found, "ACTIVE_KEYS", "ACCT", "FILES", "2026-06-01", clean, metadata=["alert"]), path)
    return spark.read.parquet(path).select("TableName", "CheckType", "Status", "SourceOnlyRows", "TargetOnlyRows", "MismatchedRows")


_VAULT = """WITH v AS (SELECT persnbr AS Token, max(UdmEffectiveDateTime) AS e, CASE WHEN persnbr % 5 = 0 THEN 1 ELSE 0 END AS h, CASE WHEN persnbr % 7 = 0 THEN 'purged' ELSE 'active' END AS s FROM pers_bronze WHERE persnbr IS NOT NULL AND persnbr % 3 <> 0 GROUP BY 1),
g AS (SELECT *, coalesce(e < TIMESTAMP '2025-01-01' AND s = 'active', false) AS due FROM v)
"""


@_query(_VAULT + """SELECT 'would_purge' AS measure, count(*) FILTER (due AND h = 0) AS n FROM g UNION ALL SELECT 'held', count(*) FILTER (due AND h <> 0) FROM g
UNION ALL SELECT 'provenance_follows', count(*) FROM pers_bronze b JOIN g ON g.Token = b.persnbr WHERE due AND h = 0 UNION ALL SELECT 'provenance_without_token', count(*) FROM pers_bronze b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.Token = b.persnbr)""")
def vault_retention(spark, folder):
    b = _t(spark, folder, "pers_bronze")
    vault = b.where("persnbr IS NOT NULL AND persnbr % 3 <> 0").groupBy(F.col("persnbr").alias("Token")).agg(F.max("UdmEffectiveDateTime").alias("RetentionExpiresAt"))
    vault = vault.withColumns({"LegalHold": F.when(F.col("Token") % 5 == 0, 1).otherwise(0), "Status": F.when(F.col("Token") % 7 == 0, "purged").otherwise("active")})
    return control.retention_preview(vault, b.select(F.col("persnbr").alias("Token")), "2025-01-01")


@_query("""SELECT 'FILES' AS SourceName, t AS TableName, v AS verdict, p AS PiiColumnList, c AS DataClassification FROM (VALUES ('ACCT', 'UPDATED', 'acctname', 'PII'), ('PERS', 'UNCHANGED', '', 'INTERNAL'), ('ORG', 'BAD_CLASS', '', 'INTERNAL'), ('NONE', 'UNKNOWN_TABLE', NULL, NULL)) x(t, v, p, c)""")
def inventory_import(spark, folder):
    config = _t(spark, folder, "file_layout").select(F.lit("FILES").alias("SourceName"), F.col("table_name").alias("TableName")).distinct().select("*", F.lit(None).cast("string").alias("PiiColumnList"), F.lit("INTERNAL").alias("DataClassification"))
    rows = [("FILES", "ACCT", " acctname ", "PII"), ("FILES", "PERS", "", "INTERNAL"), ("FILES", "ORG", "x", "SECRET"), ("FILES", "NONE", "x", "PII")]
    return control.import_inventory(config, spark.createDataFrame(rows, "SourceName string, TableName string, PiiColumnList string, DataClassification string"))


@_query("SELECT t AS table_name, c AS column_name FROM (VALUES ('ACCT', 'persnbr'), ('NONE', 'id')) x(t, c)")
def keys_missing(spark, folder):
    wanted = spark.createDataFrame([("ACCT", "ACCTNBR"), ("ACCT", "persnbr"), ("PERS", "persnbr"), ("NONE", "id")], "table_name string, column_name string")
    return control.missing_keys(wanted, _t(spark, folder, "file_layout"))


_LATE = """WITH l AS (SELECT SourceName, CycleDate, greatest(0.0, (epoch_us(CompletedAt) - epoch_us(CAST(CycleDate + 1 AS TIMESTAMP))) / 86400000000.0) AS d FROM pipelineeventlog WHERE CompletedAt IS NOT NULL AND CycleDate IS NOT NULL),
a AS (SELECT SourceName, count(*) AS samples, quantile_cont(d, 0.99) AS p99 FROM l GROUP BY 1), b AS (SELECT SourceName, quantile_cont(d, 0.99) AS p FROM l WHERE CycleDate < DATE '2026-02-01' GROUP BY 1)
"""


@_query(_LATE + """SELECT a.SourceName, samples, CAST(ceil(p99 * 1.5) AS INTEGER) AS RecommendedLookback, p AS PreviousP99, (p99 - p) / nullif(p, 0) * 100 AS DriftPct, coalesce(abs((p99 - p) / nullif(p, 0) * 100) > 20, false) AS alarm
FROM a LEFT JOIN b ON a.SourceName IS NOT DISTINCT FROM b.SourceName""")
def lateness_report(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("CompletedAt IS NOT NULL AND CycleDate IS NOT NULL")
    e = e.withColumn("d", profiling.lateness_days(F.col("CompletedAt"), F.col("CycleDate")))
    prior = profiling.lateness(e.where(F.col("CycleDate") < F.lit("2026-02-01").cast("date")), ["SourceName"], "d")
    out = control.lateness_report(profiling.lateness(e, ["SourceName"], "d"), prior, ["SourceName"])
    return out.select("SourceName", "samples", "RecommendedLookback", "PreviousP99", "DriftPct", "alarm")


@_query("""SELECT EventLogId, Status FROM pipelineeventlog WHERE coalesce(datediff('day', CAST(StartedAt AS DATE), DATE '2026-05-15') <= CASE Status WHEN 'SUCCESS' THEN 60 WHEN 'FAILED' THEN 120 ELSE 30 END, true)""")
def log_purge(spark, folder):
    return control.purge_logs(_t(spark, folder, "pipelineeventlog"), "StartedAt", "2026-05-15", {"SUCCESS": 60, "FAILED": 120}, 30).select("EventLogId", "Status")


_PATHS = ["a/year=2026/month=01/day=05/hour=3/x", "a/yyyy=2026/mm=01/dd=05/x", "a/date=2026-01-05/x", "a/year=2026/month=01/x", "a/year=2026/x", "a/x", "yearly/monthly/x"]


@_query("SELECT p AS path, l AS layout FROM (VALUES " + ", ".join(f"('{p}', '{n}')" for p, n in zip(_PATHS, ["hourly", "daily", "daily", "monthly", "yearly", "flat", "flat"], strict=True)) + ") x(p, l)")
def partition_layout(spark, folder):
    return control.partition_layout(spark.createDataFrame([(p,) for p in _PATHS], "path string"), "path")


_PER_DAY = "WITH r AS (SELECT TableName, SourceName, CycleDate AS day, max(CAST(Status = 'SUCCESS' AS INT)) AS ok, max(CAST(Status LIKE 'FAILED%' AS INT)) AS bad FROM pipelineeventlog WHERE CycleDate IS NOT NULL AND TableName IS NOT NULL AND SourceName IS NOT NULL AND EventType = 'EXTRACT' GROUP BY 1, 2, 3)"


@_query(_PER_DAY + " SELECT TableName, SourceName, day AS CycleDate FROM r WHERE coalesce(bad, 0) = 1 AND coalesce(ok, 0) = 0")
def failed_days(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("TableName IS NOT NULL AND SourceName IS NOT NULL AND EventType = 'EXTRACT'")
    return control.failed_days(e, ["TableName", "SourceName"], "CycleDate")


@_query(_PER_DAY + """, k AS (SELECT TableName, SourceName, max(day) FILTER (ok = 1) AS last FROM r GROUP BY 1, 2), s AS (SELECT *, greatest(least(coalesce(last + 1, DATE '2026-01-01'), DATE '2026-05-20' - 1 - 20), DATE '2026-01-01') AS a FROM k)
SELECT s.TableName, s.SourceName, d.day, coalesce(datediff('day', last, DATE '2026-05-19') > 20, false) AS late FROM s, LATERAL (SELECT CAST(unnest(generate_series(s.a, DATE '2026-05-19', INTERVAL 1 DAY)) AS DATE) AS day) d
WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.TableName = s.TableName AND r.SourceName = s.SourceName AND r.day = d.day AND r.ok = 1)""")
def days_to_process(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("TableName IS NOT NULL AND SourceName IS NOT NULL AND EventType = 'EXTRACT' AND CycleDate IS NOT NULL")
    return control.days_to_process(e, ["TableName", "SourceName"], "CycleDate", "2026-05-20", 20, "2026-01-01")


@_query("""WITH r AS (SELECT *, dayofweek(CycleDate) = dayofweek(DATE '2026-02-20') AND CycleDate > DATE '2026-02-20' - 30 AS same FROM pipelineeventlog WHERE EventType = 'EXTRACT' AND RowsProcessed IS NOT NULL AND CycleDate <= DATE '2026-02-20'),
m AS (SELECT *, count(*) FILTER (same) OVER (PARTITION BY TableName, SourceName) AS n FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY TableName, SourceName ORDER BY CycleDate DESC, EventLogId DESC, RowsProcessed DESC) AS rn FROM m WHERE same OR n < 2)
SELECT TableName, SourceName, CAST(floor(quantile_cont(RowsProcessed, 0.5)) AS BIGINT) AS baseline FROM k WHERE rn <= 14 GROUP BY 1, 2""")
def daily_baseline(spark, folder):
    e = _t(spark, folder, "pipelineeventlog").where("EventType = 'EXTRACT'")
    return profiling.daily_baseline(e, ["TableName", "SourceName"], "CycleDate", "RowsProcessed", "2026-02-20")


# Comparison ---------------------------------------------------------------------------------------

_FIELDS = {"branchnbr": "v", "mjaccttypcd": "s", "acctstatcd": "s", "acctname": "s", "curbal": "d", "intrate": "d", "opendate": "v", "note": "s"}


def _unlike(c: str, kind: str) -> str:
    if kind == "s":
        return f"rtrim(nfc_normalize(s.{c}), ' ') IS DISTINCT FROM rtrim(nfc_normalize(t.{c}), ' ')"
    if kind == "d":
        return f"NOT CASE WHEN s.{c} IS NULL OR t.{c} IS NULL THEN s.{c} IS NULL AND t.{c} IS NULL WHEN isnan(s.{c}) OR isnan(t.{c}) THEN isnan(s.{c}) AND isnan(t.{c}) ELSE abs(s.{c} - t.{c}) < 0.000001 END"
    return f"s.{c} IS DISTINCT FROM t.{c}"


def _compared(where: str) -> str:
    counts = ", ".join(f"count(*) FILTER ({_unlike(c, k)})" for c, k in _FIELDS.items())
    names = ", ".join(f"'{c}'" for c in _FIELDS)
    either = " OR ".join(f"({_unlike(c, k)})" for c, k in _FIELDS.items())
    s, t = (f"(SELECT DISTINCT ON (batch_id, acctnbr) * FROM {n} WHERE acctnbr IS NOT NULL)" for n in ("acct_source", "acct_stage"))
    return f"SELECT unnest([{names}, 'any column']) AS column_name, unnest([{counts}, count(*) FILTER ({either})]) AS mismatches FROM {s} s JOIN {t} t ON s.batch_id = t.batch_id AND s.acctnbr = t.acctnbr {where}"


def _one_each(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tuple(_t(spark, folder, n).where("acctnbr IS NOT NULL").dropDuplicates(["batch_id", "acctnbr"]) for n in ("acct_source", "acct_stage"))


@_query(_compared(""))
def columns_compare_values(spark, folder):
    """All eight fields, by value."""
    return reconcile.columns_compare(*_one_each(spark, folder), ["batch_id", "acctnbr"], list(_FIELDS), by_value=True)


@_query(_compared("WHERE s.opendate >= DATE '2015-01-01' AND s.opendate < DATE '2020-01-01' AND t.opendate >= DATE '2015-01-01' AND t.opendate < DATE '2020-01-01'"))
def columns_compare_window(spark, folder):
    return reconcile.columns_compare_in(*_one_each(spark, folder), ["batch_id", "acctnbr"], list(_FIELDS), "opendate", "2015-01-01", "2020-01-01")


@_query("""SELECT unnest(['o_totalprice', 'o_custkey']) AS column_name, unnest([min(o_totalprice), CAST(min(o_custkey) AS DOUBLE)]) AS a_min, unnest([max(o_totalprice), CAST(max(o_custkey) AS DOUBLE)]) AS a_max,
  unnest([min(o_totalprice) FILTER (o_orderkey % 7 <> 0), CAST(min(o_custkey) FILTER (o_orderkey % 7 <> 0) AS DOUBLE)]) AS b_min, unnest([max(o_totalprice) FILTER (o_orderkey % 7 <> 0), CAST(max(o_custkey) FILTER (o_orderkey % 7 <> 0) AS DOUBLE)]) AS b_max FROM orders""")
def aggregate_extremes(spark, folder):
    o = _t(spark, folder, "orders")
    return reconcile.aggregate_reconcile(o, o.where("o_orderkey % 7 <> 0"), ["o_totalprice", "o_custkey"], extremes=True).select("column_name", "a_min", "a_max", "b_min", "b_max")


@_query("""WITH s AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS d, avg(l_quantity * 4 + 40) AS n, avg(l_discount) AS m2, stddev_samp(l_discount) AS d2 FROM lineitem)
SELECT 'l_quantity' AS column_name, abs(n - m) / d > 2 AS shifted FROM s UNION ALL SELECT 'l_discount', false FROM s""")
def distribution_shift_found(spark, folder):
    df = _t(spark, folder, "lineitem").select("l_quantity", "l_discount")
    return reconcile.distribution_shift(df, df.withColumn("l_quantity", F.col("l_quantity") * 4 + 40), ["l_quantity", "l_discount"]).select("column_name", "shifted")


@_query("SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 100")
def sample_100(spark, folder):
    return reconcile.sample_n(_t(spark, folder, "customer"), ["c_custkey"], 100).select("c_custkey", "c_name")


@_query(_ORDERS + """, k AS (SELECT count(*) FILTER (change = 'D') AS missing_from_bronze, count(*) FILTER (change = 'I') AS missing_from_snapshot, count(*) FILTER (change = 'S') AS hash_same, count(*) FILTER (change = 'U') AS hash_differs FROM c WHERE o_orderkey % 10 <> 0)
SELECT CASE WHEN missing_from_snapshot > 0 THEN 'MAJOR_DRIFT' WHEN missing_from_bronze + hash_same + hash_differs = 0 THEN 'CLEAN' WHEN (missing_from_bronze + hash_differs) / (missing_from_bronze + hash_same + hash_differs) > t2 THEN 'MAJOR_DRIFT'
  WHEN (missing_from_bronze + hash_differs) / (missing_from_bronze + hash_same + hash_differs) > t1 THEN 'DRIFT' ELSE 'CLEAN' END AS verdict, n AS try FROM k, (VALUES (1, 0.01, 0.05), (2, 0.2, 0.5), (3, 0.5, 0.9)) v(n, t1, t2)""")
def hash_verdicts(spark, folder):
    """The verdict on one comparison of hashes at three tolerances."""
    whole = _existing(spark, folder)
    n = reconcile.key_hashes(whole, _fresh(spark, folder).where("o_orderkey % 10 <> 0"), ["o_orderkey"], "_row_hash", "_row_hash")
    tries = [n.select(reconcile.hash_verdict(a, b).alias("verdict"), F.lit(i).alias("try")) for i, a, b in ((1, 0.01, 0.05), (2, 0.2, 0.5), (3, 0.5, 0.9))]
    return tries[0].unionByName(tries[1]).unionByName(tries[2])


@_query(_ACCT + _LAST + """, r AS (SELECT count(*) FILTER (kind = 'bronze_only') AS orphans, count(*) FILTER (kind = 'stage_only') AS missing, count(*) FILTER (kind = 'hash_mismatch') AS hash_mismatches, (SELECT count(*) FROM s WHERE c > 1) AS stage_duplicates,
 (SELECT count(*) FROM b WHERE a > 1) AS bronze_duplicates, (SELECT count(*) FROM b WHERE a > 0 AND d > 0) AS active_and_deleted, (SELECT count(*) FROM b WHERE a = 0 AND d = 0) AS zero_active, (SELECT count(*) FROM br WHERE f = 0 AND op IN ('U', 'R') AND e IS NULL) AS in_flight FROM dr)
UNPIVOT r ON orphans, missing, hash_mismatches, stage_duplicates, bronze_duplicates, active_and_deleted, zero_active, in_flight INTO NAME check_name VALUE n""")
def cdc_validated(spark, folder):
    return reconcile.validate_cdc(_t(spark, folder, "acct_change"), _accounts_as_bronze(spark, folder), ["acctnbr"])


_W = "pers_bronze WHERE persnbr IS NOT NULL"


def _first_keys(name: str, where: str) -> str:
    return f"SELECT * FROM (SELECT DISTINCT '{name}' AS check_name, persnbr FROM {_W} AND ({where}) ORDER BY persnbr LIMIT 5)"


@_query(" UNION ALL ".join([
    _first_keys("missing_sentinel", "UdmActiveFlag = 1 AND (UdmSourceEndDate IS NULL OR UdmSourceEndDate <> TIMESTAMP '2999-12-31')"), _first_keys("active_with_end", "UdmActiveFlag = 1 AND UdmEndDateTime IS NOT NULL"),
    _first_keys("bad_flag", "UdmActiveFlag IS NULL OR UdmActiveFlag NOT IN (0, 1, 2)"), _first_keys("bad_operation", "UdmScd2Operation IS NULL OR UdmScd2Operation NOT IN ('I', 'U', 'R', 'D')"),
    _first_keys("in_flight", "UdmActiveFlag = 0 AND UdmScd2Operation IN ('U', 'R') AND UdmEndDateTime IS NULL AND UdmSourceEndDate IS NULL"), _first_keys("deleted_without_end", "UdmActiveFlag = 2 AND UdmEndDateTime IS NULL"),
    _first_keys("deleted_with_sentinel", "UdmActiveFlag = 2 AND UdmSourceEndDate = TIMESTAMP '2999-12-31'"),
    f"""SELECT * FROM (SELECT DISTINCT 'overlap', a.persnbr FROM pers_bronze a JOIN pers_bronze b ON a.persnbr = b.persnbr AND a._scd2_key <> b._scd2_key WHERE a.UdmEffectiveDateTime < coalesce(b.UdmEndDateTime, TIMESTAMP '9999-12-31')
      AND b.UdmEffectiveDateTime < coalesce(a.UdmEndDateTime, TIMESTAMP '9999-12-31') ORDER BY 2 LIMIT 5)""",
    f"""SELECT * FROM (SELECT DISTINCT 'version_gap', persnbr FROM (SELECT persnbr, UdmEffectiveDateTime AS b, lag(coalesce(UdmEndDateTime, TIMESTAMP '9999-12-31')) OVER (PARTITION BY persnbr ORDER BY UdmEffectiveDateTime, _scd2_key) AS p FROM {_W})
      WHERE floor(epoch_us(b) / 1000000) - floor(epoch_us(p) / 1000000) > 1 ORDER BY 2 LIMIT 5)""",
    """SELECT * FROM (SELECT DISTINCT 'business_overlap', a.persnbr FROM pers_bronze a JOIN pers_bronze b ON a.persnbr = b.persnbr AND a._scd2_key <> b._scd2_key
      AND a.UdmSourceBeginDate < b.UdmSourceEndDate AND b.UdmSourceBeginDate < a.UdmSourceEndDate ORDER BY 2 LIMIT 5)""",
    f"""SELECT * FROM (SELECT DISTINCT 'business_gap', persnbr FROM (SELECT persnbr, UdmSourceBeginDate AS b, lag(UdmSourceEndDate) OVER (PARTITION BY persnbr ORDER BY UdmSourceBeginDate, _scd2_key) AS p FROM {_W})
      WHERE p < TIMESTAMP '2999-12-31' AND datediff('day', CAST(p AS DATE), CAST(b AS DATE)) > 1 ORDER BY 2 LIMIT 5)""",
]))
def integrity_samples(spark, folder):
    return integrity.samples(_t(spark, folder, "pers_bronze"), ["persnbr"])


@_query("""SELECT TableName, SourceName, day, coalesce(day <= last, false) AS again FROM (SELECT TableName, SourceName, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2026-02-01', INTERVAL 1 DAY)) AS DATE) AS day FROM
  (SELECT DISTINCT TableName, SourceName FROM pipelineeventlog WHERE CycleDate IS NOT NULL AND TableName IS NOT NULL AND SourceName IS NOT NULL)) LEFT JOIN (SELECT TableName, SourceName, max(CycleDate) AS last FROM pipelineeventlog WHERE Status = 'SUCCESS' GROUP BY 1, 2) USING (TableName, SourceName)""")
def range_plan_of_all(spark, folder):
    """Two years and a month for every table: more days than a year has, none left out."""
    runs = _t(spark, folder, "pipelineeventlog").where("CycleDate IS NOT NULL AND TableName IS NOT NULL AND SourceName IS NOT NULL")
    policies = runs.select("TableName", "SourceName").distinct().select("*", F.lit("2024-01-01").cast("date").alias("start_day"), F.lit(None).cast("date").alias("end_day"))
    return profiling.plan_range(policies, runs, ["TableName", "SourceName"], "CycleDate", F.col("Status") == "SUCCESS", "2026-02-01", 7)
