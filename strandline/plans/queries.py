"""Queries over a folder of Parquet tables, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import apply_changes, entity_history, reconcile_copies, reject_records, snapshot_changes

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return apply_changes.accounts_at_end(spark, f"{folder}/acct_change.parquet").select("acctnbr", "change_id")


def p1_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    return apply_changes.accounts_after_batches(spark, table(spark, folder, "acct_change")).select("acctnbr", "change_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    source, stage, log = (table(spark, folder, t) for t in ("acct_source", "acct_stage", "reconciliationlog"))
    return reconcile_copies.account_findings(spark, source, stage, log)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return entity_history.person_history(table(spark, folder, "pers_bronze"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_changes.account_changes(table(spark, folder, "acct_snapshot"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return reject_records.rejected(table(spark, folder, "quarantine"), table(spark, folder, "file_layout"))


def _typed(name: str) -> Query:
    """Typed rows of one file; its decimals are shown as doubles, which every engine spells alike."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = reject_records.typed_rows(table(spark, folder, "quarantine"), table(spark, folder, "file_layout"), name)
        return rows.withColumns({f.name: F.col(f.name).cast("double") for f in rows.schema.fields if isinstance(f.dataType, T.DecimalType)})

    return query


TRAINING: dict[str, Query] = {
    "p1_found": p1_found,
    "p1_in_batches": p1_in_batches,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_rows_acct": _typed("ACCT"),
    "p5_rows_cardtxn": _typed("CARDTXN"),
    "p5_rows_pers": _typed("PERS"),
    "p5_rows_org": _typed("ORG"),
}


def _differs(column: str, kind: str) -> str:
    if kind == "double":
        return (
            f"NOT CASE WHEN s.{column} IS NULL OR t.{column} IS NULL THEN s.{column} IS NULL AND t.{column} IS NULL "
            f"WHEN isnan(s.{column}) OR isnan(t.{column}) THEN isnan(s.{column}) AND isnan(t.{column}) "
            f"ELSE abs(s.{column} - t.{column}) < 0.000001 END"
        )
    if kind == "string":
        return f"rtrim(nfc_normalize(s.{column}), ' ') IS DISTINCT FROM rtrim(nfc_normalize(t.{column}), ' ')"
    return f"s.{column} IS DISTINCT FROM t.{column}"


_COPIES = {
    "branchnbr": "int", "mjaccttypcd": "string", "acctstatcd": "string", "acctname": "string",
    "curbal": "double", "intrate": "double", "opendate": "date", "note": "string",
}
_SNAPSHOT = {c: _COPIES[c] for c in ("acctname", "acctstatcd", "mjaccttypcd", "branchnbr", "curbal", "intrate", "note")}

_P1 = """
WITH once AS (
  SELECT acctnbr, change_id, min(_cdc_batch_id) AS batch, min(_cdc_valid_from) AS since, upper(left(trim(min(_cdc_operation)), 1)) AS op
  FROM acct_change WHERE acctnbr IS NOT NULL AND _cdc_valid_from IS NOT NULL GROUP BY acctnbr, change_id
), last AS (SELECT *, row_number() OVER (PARTITION BY acctnbr ORDER BY since DESC, batch DESC, change_id DESC) AS rn FROM once)
SELECT acctnbr, change_id FROM last WHERE rn = 1 AND op <> 'D'
"""

_P2 = f"""
WITH s AS (SELECT DISTINCT ON (batch_id, acctnbr) * FROM acct_source WHERE batch_id IS NOT NULL AND acctnbr IS NOT NULL),
t AS (SELECT DISTINCT ON (batch_id, acctnbr) * FROM acct_stage WHERE batch_id IS NOT NULL AND acctnbr IS NOT NULL),
j AS (
  SELECT coalesce(s.batch_id, t.batch_id) AS batch_id, coalesce(s.acctnbr, t.acctnbr) AS acctnbr,
    CASE WHEN t.acctnbr IS NULL THEN ['source_only'] WHEN s.acctnbr IS NULL THEN ['target_only']
    ELSE list_filter([{", ".join(f"CASE WHEN {_differs(c, k)} THEN '{c}' END" for c, k in _COPIES.items())}], lambda x: x IS NOT NULL) END AS names
  FROM s FULL JOIN t ON s.batch_id = t.batch_id AND s.acctnbr = t.acctnbr
), f AS (SELECT * FROM j WHERE len(names) > 0),
sc AS (SELECT batch_id, count(*) AS n FROM s GROUP BY batch_id), tc AS (SELECT batch_id, count(*) AS n FROM t GROUP BY batch_id),
fc AS (
  SELECT batch_id, count(*) FILTER (names[1] = 'source_only') AS so, count(*) FILTER (names[1] = 'target_only') AS tgt,
    count(*) FILTER (names[1] NOT IN ('source_only', 'target_only')) AS mm FROM f GROUP BY batch_id
), l AS (
  SELECT *, row_number() OVER (PARTITION BY BatchId ORDER BY RunDate DESC NULLS LAST, Id DESC) AS rn FROM reconciliationlog WHERE BatchId IS NOT NULL
), w AS (
  SELECT l.BatchId AS batch_id, list_filter([
    CASE WHEN SourceRows IS DISTINCT FROM coalesce(sc.n, 0) THEN 'SourceRows' END,
    CASE WHEN TargetRows IS DISTINCT FROM coalesce(tc.n, 0) THEN 'TargetRows' END,
    CASE WHEN MismatchedRows IS DISTINCT FROM coalesce(mm, 0) THEN 'MismatchedRows' END,
    CASE WHEN SourceOnlyRows IS DISTINCT FROM coalesce(so, 0) THEN 'SourceOnlyRows' END,
    CASE WHEN TargetOnlyRows IS DISTINCT FROM coalesce(tgt, 0) THEN 'TargetOnlyRows' END], lambda x: x IS NOT NULL) AS names
  FROM l LEFT JOIN sc ON l.BatchId = sc.batch_id LEFT JOIN tc ON l.BatchId = tc.batch_id LEFT JOIN fc ON l.BatchId = fc.batch_id WHERE rn = 1
)
SELECT batch_id, acctnbr, unnest(names) AS field_name FROM f
UNION ALL SELECT batch_id, CAST(-1 AS BIGINT), unnest(names) FROM w
"""

_P4 = f"""
WITH r AS (
  SELECT DISTINCT ON (_cdc_batch_id, sourcename, acctnbr) * FROM acct_snapshot
  WHERE _cdc_is_current = 1 AND acctnbr IS NOT NULL AND sourcename IS NOT NULL AND _cdc_batch_id IS NOT NULL
), b AS (SELECT id, lag(id) OVER (ORDER BY id) AS prior FROM (SELECT DISTINCT _cdc_batch_id AS id FROM r)),
t AS (SELECT r.*, b.id FROM r JOIN b ON r._cdc_batch_id = b.id WHERE b.prior IS NOT NULL),
s AS (SELECT r.*, b.id FROM r JOIN b ON r._cdc_batch_id = b.prior)
SELECT coalesce(s.id, t.id) AS batch_id, coalesce(s.sourcename, t.sourcename) AS sourcename, coalesce(s.acctnbr, t.acctnbr) AS acctnbr,
  CASE WHEN s.acctnbr IS NULL THEN 'I' WHEN t.acctnbr IS NULL THEN 'D' ELSE 'U' END AS op
FROM s FULL JOIN t ON s.id = t.id AND s.sourcename = t.sourcename AND s.acctnbr = t.acctnbr
WHERE s.acctnbr IS NULL OR t.acctnbr IS NULL OR {" OR ".join(_differs(c, k) for c, k in _SNAPSHOT.items())}
"""

# The rows of a person are walked one by one, the version that is open carried along.
_P3 = """
WITH RECURSIVE once AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY persnbr, UdmEffectiveDateTime ORDER BY _scd2_key DESC NULLS LAST) AS rn
    FROM pers_bronze WHERE persnbr IS NOT NULL AND UdmEffectiveDateTime IS NOT NULL
  ) WHERE rn = 1
), r AS (
  SELECT persnbr, epoch_us(UdmEffectiveDateTime) AS t, CASE WHEN upper(trim(UdmScd2Operation, ' ')) = 'D' THEN 2 ELSE 1 END AS kind,
    rtrim(nfc_normalize(persname), ' ') AS a, rtrim(nfc_normalize(segment), ' ') AS b, rtrim(nfc_normalize(city), ' ') AS c, riskscore AS d,
    CASE WHEN upper(trim(UdmScd2Operation, ' ')) IS DISTINCT FROM 'D' AND UdmActiveFlag = 2 AND UdmEndDateTime > UdmEffectiveDateTime THEN epoch_us(UdmEndDateTime) END AS fin
  FROM once
), ev AS (
  SELECT persnbr, t, kind, a, b, c, d, t AS origin FROM r
  UNION ALL SELECT persnbr, fin, 0, NULL, NULL, NULL, NULL, t FROM r WHERE fin IS NOT NULL
), n AS (SELECT *, row_number() OVER (PARTITION BY persnbr ORDER BY t, kind, origin) AS i, count(*) OVER (PARTITION BY persnbr) AS many FROM ev),
w AS (
  SELECT persnbr, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS many, CAST(NULL AS BIGINT) AS since, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b,
    CAST(NULL AS VARCHAR) AS c, CAST(NULL AS DOUBLE) AS d, CAST(NULL AS BIGINT) AS begin_us, CAST(NULL AS BIGINT) AS end_us, CAST(NULL AS INTEGER) AS flag
  FROM (SELECT DISTINCT persnbr FROM n)
  UNION ALL
  SELECT persnbr, i, many,
    CASE kind WHEN 1 THEN CASE WHEN goes_on THEN since ELSE t END WHEN 2 THEN NULL ELSE CASE WHEN since > origin THEN since END END,
    CASE kind WHEN 1 THEN a2 ELSE a END, CASE kind WHEN 1 THEN b2 ELSE b END, CASE kind WHEN 1 THEN c2 ELSE c END, CASE kind WHEN 1 THEN d2 ELSE d END,
    CASE WHEN closes THEN since END, CASE WHEN closes THEN t END, CASE WHEN closes THEN CASE kind WHEN 1 THEN 0 ELSE 2 END END
  FROM (
    SELECT *, since IS NOT NULL AND CASE kind WHEN 1 THEN NOT goes_on WHEN 2 THEN true ELSE since <= origin END AS closes FROM (
      SELECT w.persnbr, n.i, n.many, n.t, n.kind, n.origin, w.since, w.a, w.b, w.c, w.d, n.a AS a2, n.b AS b2, n.c AS c2, n.d AS d2,
        w.since IS NOT NULL AND w.a IS NOT DISTINCT FROM n.a AND w.b IS NOT DISTINCT FROM n.b AND w.c IS NOT DISTINCT FROM n.c
        AND CASE WHEN w.d IS NULL OR n.d IS NULL THEN w.d IS NULL AND n.d IS NULL WHEN isnan(w.d) OR isnan(n.d) THEN isnan(w.d) AND isnan(n.d)
          ELSE w.d = n.d OR abs(w.d - n.d) < 0.000001 END AS goes_on
      FROM w JOIN n ON n.persnbr = w.persnbr AND n.i = w.i + 1
    )
  )
)
SELECT persnbr, begin_us, end_us, flag AS active_flag FROM w WHERE begin_us IS NOT NULL
UNION ALL SELECT persnbr, since, CAST(0 AS BIGINT), 1 FROM w WHERE i = many AND since IS NOT NULL
"""

# A field is either quoted as a whole or without any quote; patterns are put together from each file's delimiter.
_P5 = """
WITH q AS (
  SELECT QuarantineId, TableName, CASE WHEN ends_with(RecordData, chr(13) || chr(10)) THEN RecordData[:-3]
    WHEN ends_with(RecordData, chr(10)) OR ends_with(RecordData, chr(13)) THEN RecordData[:-2] ELSE RecordData END AS rec FROM quarantine
), l AS (SELECT table_name, any_value(delimiter) AS d, count(*) AS n FROM file_layout GROUP BY 1),
k AS (SELECT q.*, coalesce(l.d, ',') AS d, l.n FROM q LEFT JOIN l ON q.TableName = l.table_name),
p AS (SELECT *, '(?:"(?:[^"]|"")*"|[^"' || d || ']*)' AS one FROM k),
g AS (
  SELECT QuarantineId, TableName, rec, n, regexp_full_match(rec, one || '(?:[' || d || ']' || one || ')*') AS sound,
    regexp_extract_all(d || rec, '[' || d || '](' || one || ')', 1) AS fields FROM p
), c AS (
  SELECT g.QuarantineId, g.TableName, y.ordinal, y.column_name, lower(y.value_type) AS kind, y.nullable, g.fields[y.ordinal] AS raw,
    CASE WHEN g.fields[y.ordinal] LIKE '"%' THEN replace(substr(g.fields[y.ordinal], 2, length(g.fields[y.ordinal]) - 2), '""', '"') ELSE g.fields[y.ordinal] END AS v,
    TRY_CAST(regexp_extract(y.value_type, '[(]([0-9]+)', 1) AS INTEGER) AS p, coalesce(TRY_CAST(regexp_extract(y.value_type, ',[ ]*([0-9]+)', 1) AS INTEGER), 0) AS s
  FROM g JOIN file_layout y ON y.table_name = g.TableName WHERE g.sound AND len(g.fields) = g.n
), t AS (
  SELECT *, CASE WHEN raw = '' THEN nullable
    WHEN kind = 'bigint' THEN regexp_full_match(v, '-?[0-9]{1,18}')
    WHEN kind LIKE 'decimal%' THEN regexp_full_match(v, '-?[0-9]{1,' || (p - s) || '}(?:[.][0-9]{1,' || s || '})?')
    WHEN kind = 'date' THEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND v >= '0001' AND TRY_CAST(v AS DATE) IS NOT NULL
    WHEN kind = 'timestamp' THEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2} (?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:[.][0-9]{3})?') AND v >= '0001' AND TRY_CAST(v[:10] AS DATE) IS NOT NULL
    WHEN kind = 'flag' THEN v IN ('Y', 'N')
    ELSE length(v) <= p END AS ok FROM c
)"""
_P5_FOUND = _P5 + """, b AS (SELECT QuarantineId, arg_min(column_name, ordinal) AS column_name FROM t WHERE NOT ok GROUP BY 1)
SELECT g.QuarantineId, CASE WHEN rec IS NULL THEN 'COLUMN_COUNT' WHEN NOT sound THEN 'QUOTING' WHEN n IS NULL OR len(fields) <> n THEN 'COLUMN_COUNT' ELSE 'VALUE' END AS reason,
  coalesce(b.column_name, '') AS column_name
FROM g LEFT JOIN b ON b.QuarantineId = g.QuarantineId
WHERE rec IS NULL OR NOT sound OR n IS NULL OR len(fields) <> n OR b.column_name IS NOT NULL
"""
#: The columns of the four files and the kinds that are no text.
_FILES = {
    "ACCT": {"acctnbr": "BIGINT", "acctname": "", "mjaccttypcd": "", "opendate": "DATE", "curbal": "DOUBLE", "closed": "FLAG", "note": ""},
    "CARDTXN": {
        "txnnbr": "BIGINT", "acctnbr": "BIGINT", "txntime": "TIMESTAMP", "amount": "DOUBLE", "currency": "", "memo": "", "reversed": "FLAG", "rate": "DOUBLE", "branchnbr": "BIGINT",
    },
    "PERS": {"persnbr": "BIGINT", "persname": "", "birthdate": "DATE", "city": "", "active": "FLAG", "changed": "TIMESTAMP"},
    "ORG": {"orgnbr": "BIGINT", "orgname": "", "since": "DATE", "capital": "DOUBLE", "remark": ""},
}


def _p5_rows(name: str) -> str:
    def value(column: str, kind: str) -> str:
        text = f"max(CASE WHEN column_name = '{column}' AND raw <> '' THEN v END)"
        return f"{f'{text} = {chr(39)}Y{chr(39)}' if kind == 'FLAG' else f'CAST({text} AS {kind})' if kind else text} AS {column}"

    columns = ", ".join(value(c, k) for c, k in _FILES[name].items())
    return f"{_P5} SELECT QuarantineId, {columns} FROM t WHERE TableName = '{name}' GROUP BY QuarantineId HAVING bool_and(ok)"


TRAINING_SQL: dict[str, str] = {"p1_found": _P1, "p1_in_batches": _P1, "p2_found": _P2, "p3_found": _P3, "p4_found": _P4, "p5_found": _P5_FOUND}
TRAINING_SQL |= {f"p5_rows_{name.lower()}": _p5_rows(name) for name in _FILES}
