"""Control tables of the pipeline: events, attempts, the step ledger, configuration, inventories, stored results.

All are relations: what happened goes in as a DataFrame, and the table's next state comes out.  They
are small next to the data (a row per step, table or run), but nothing here gathers them on the driver.
Keys and times that are null never match; empty tables give empty ones, and columns that aren't named
are carried through.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import micros
from .cleaning import keep_first

#: States of a step in the event log, and those of an extraction attempt.
EVENT_STATES = ("IN_PROGRESS", "SUCCESS", "FAILED", "SKIPPED")
ATTEMPT_STATES = ("IN_PROGRESS", "SUCCESS", "FAILED")
#: What a step may do, by the state of its ledger row.
GATE = {"COMPLETED": "SKIP", "IN_PROGRESS": "BUSY", "FAILED": "RETRY"}
#: The classes that an inventory may give a table's data.
CLASSES = ("PII", "PCI", "GLBA", "SOX", "INTERNAL", "PUBLIC", "NONE")
#: Characters of an error message that are kept.
MESSAGE = 4000


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def finish_events(events: DataFrame) -> DataFrame:
    """Events with final Status, DurationMs and RowsPerSecond.

    A step with an error message has failed, one that is still in progress without one has succeeded;
    a state that isn't known counts as success, as does none.  Rows per second are hundredths, rounded
    half up in whole numbers; 0 if no time passed or no rows came.
    """
    ms = F.floor((micros(F.col("CompletedAt")) - micros(F.col("StartedAt"))) / 1000).cast("bigint")
    status = F.when(F.col("ErrorMessage").isNotNull(), "FAILED").when(F.col("Status").isin("FAILED", "SKIPPED"), F.col("Status")).otherwise("SUCCESS")
    # Twice the hundredths, so that the half is a whole number.
    rate = F.expr("(RowsProcessed * 200000 + DurationMs) div (2 * DurationMs)") / 100.0
    rated = events.withColumns({"Status": status, "ErrorMessage": F.substring("ErrorMessage", 1, MESSAGE), "DurationMs": ms})
    return rated.withColumn("RowsPerSecond", F.when((F.col("DurationMs") > 0) & (F.col("RowsProcessed") > 0), rate).otherwise(0.0))


def record_attempts(log: DataFrame, fresh: DataFrame, keys: Sequence[str], at: str, tie: str) -> DataFrame:
    """``log`` with the new attempts, numbered on from the highest ``Attempt`` of their key, in order of time."""
    last = log.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.max("Attempt").alias("__last"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(at).asc_nulls_last(), tie))
    numbered = fresh.withColumn("__place", place).join(last, list(keys), "left")
    return log.unionByName(numbered.withColumn("Attempt", (F.coalesce("__last", F.lit(0)) + F.col("__place")).cast("int")).drop("__place", "__last"))


def bad_attempts(fresh: DataFrame) -> DataFrame:
    """Attempts that can't be recorded: an unknown state, a batch that isn't a positive number, or no table, source or day."""
    return fresh.where(
        ~F.coalesce(F.col("Status").isin(*ATTEMPT_STATES), F.lit(False))
        | ~F.coalesce(F.col("BatchId") > 0, F.lit(False))
        | (F.coalesce(F.col("TableName"), F.lit("")) == "")
        | (F.coalesce(F.col("SourceName"), F.lit("")) == "")
        | F.col("CycleDate").isNull()
    )


def ledger_gate(ledger: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, decision) of every step that is wanted: RUN if it never ran, SKIP, BUSY or RETRY by the state
    of its ledger row; UNKNOWN for a state that the ledger shouldn't have.  A step asked for twice counts once."""
    state = F.col("__status")
    decision = F.when(~F.col("__known").isNotNull(), "RUN")
    for name, answer in GATE.items():
        decision = decision.when(state == name, answer)
    known = ledger.select(*keys, F.col("Status").alias("__status"), F.lit(True).alias("__known"))
    return wanted.select(*keys).distinct().join(known, list(keys), "left").select(*keys, decision.otherwise("UNKNOWN").alias("decision"))


def ledger_finish(ledger: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ledger after steps ended: ``done`` has their keys, Status, CompletedAt and ErrorMessage.

    Rows of steps that the ledger didn't have are added; of several ends of one step the latest counts.
    """
    last = keep_first(done, keys, [F.col("CompletedAt").desc_nulls_last(), F.col("Status").desc_nulls_last()])
    ends = last.select(*keys, F.struct("Status", "CompletedAt", F.substring("ErrorMessage", 1, MESSAGE).alias("ErrorMessage")).alias("__end"))
    both = ledger.join(ends, list(keys), "full")
    new = {c: F.when(F.col("__end").isNotNull(), F.col(f"__end.{c}")).otherwise(F.col(c)) for c in ("Status", "CompletedAt", "ErrorMessage")}
    return both.withColumns(new).drop("__end")


def ledger_sweep(ledger: DataFrame, as_of: str, minutes: int = 60, most: int = 10, spare: Sequence[str] = ()) -> DataFrame:
    """The ledger with steps that are in progress for longer than that marked as failed.

    Steps of the event types in ``spare`` stay as they are.  More than ``most`` stale steps point at
    something worse than a crash: RuntimeError, and nothing is swept.
    """
    stale = (F.col("Status") == "IN_PROGRESS") & (F.col("StartedAt") < _ts(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")) & ~F.col("EventType").isin(*spare or [""])
    n = ledger.agg(F.count_if(stale).alias("n")).first()["n"]
    if n > most:
        raise RuntimeError(f"{n} steps are stale, more than {most}")
    marked = F.coalesce(stale, F.lit(False))
    return ledger.withColumns(
        {
            "CompletedAt": F.when(marked, _ts(as_of)).otherwise(F.col("CompletedAt")),
            "ErrorMessage": F.when(marked, "stale at start").otherwise(F.col("ErrorMessage")),
            "RecoveryAction": F.when(marked, "SWEPT"),
            "Status": F.when(marked, "FAILED").otherwise(F.col("Status")),
        }
    )


def config_entries(config: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, name, value) of every entry of a JSON object, or, of a JSON list, of every element with its place
    from 0 as name.  Values are texts as JSON writes them; what is no JSON object or list has none."""
    text = F.trim(column)
    listed = F.from_json(text, "array<string>")
    as_map = F.map_from_arrays(F.transform(F.sequence(F.lit(0), F.size(listed) - 1), lambda i: i.cast("string")), listed)
    entries = F.when(text.startswith("["), F.when(F.size(listed) > 0, as_map)).when(text.startswith("{"), F.from_json(text, "map<string,string>"))
    return config.select(*keys, F.explode(entries).alias("name", "value"))


def propose_config(columns: DataFrame, profiles: DataFrame) -> DataFrame:
    """(SourceName, TableName, FieldName, ProposedValue): configuration proposed from column names.

    ``columns`` has SourceName, TableName and ColumnName; ``profiles`` says which columns a source's tables
    use for a field: SourceName, FieldName, ColumnName, Priority, and Most, how many of those that exist are
    listed, in order of priority.  Where a source's profile finds nothing for a field, that of source ``*`` is tried.
    """
    p = profiles.select(F.col("SourceName").alias("__of"), "FieldName", "ColumnName", "Priority", "Most")
    hits = columns.distinct().join(p, "ColumnName").where((F.col("__of") == F.col("SourceName")) | (F.col("__of") == "*"))
    general = (F.col("__of") == "*").cast("int")
    w = Window.partitionBy("SourceName", "TableName", "FieldName")
    best = hits.withColumn("__g", general).withColumn("__least", F.min("__g").over(w)).where(F.col("__g") == F.col("__least"))
    ranked = best.withColumn("__rn", F.row_number().over(w.orderBy("Priority", "ColumnName"))).where(F.col("__rn") <= F.col("Most"))
    listed = ranked.groupBy("SourceName", "TableName", "FieldName").agg(F.sort_array(F.collect_list(F.struct("__rn", "ColumnName"))).alias("__l"))
    return listed.select("SourceName", "TableName", "FieldName", F.array_join(F.transform("__l", lambda x: x["ColumnName"]), ",").alias("ProposedValue"))


def apply_approved(config: DataFrame, proposals: DataFrame, fields: Sequence[str], at: str) -> tuple[DataFrame, DataFrame]:
    """(configuration, proposals) after the approved proposals that weren't applied yet.

    Of several for one field the one with the highest ProposalId holds; unknown fields are left alone.
    """
    due = (F.col("Status") == "APPROVED") & F.col("AppliedAt").isNull() & F.col("FieldName").isin(*fields)
    values = [F.max_by(F.struct("ProposedValue"), F.when(F.col("FieldName") == f, F.col("ProposalId"))).alias(f"__{f}") for f in fields]
    per = proposals.where(due).groupBy("SourceName", "TableName").agg(*values)
    new = {f: F.when(F.col(f"__{f}").isNotNull(), F.col(f"__{f}.ProposedValue")).otherwise(F.col(f)) for f in fields}
    after = config.join(per, ["SourceName", "TableName"], "left").withColumns(new).drop(*[f"__{f}" for f in fields])
    return after, proposals.withColumn("AppliedAt", F.when(due, _ts(at)).otherwise(F.col("AppliedAt")))


def _size(kind: str, n: int) -> Column:
    return F.coalesce(F.try_element_at(F.regexp_extract_all(kind, F.lit("([0-9]+)"), F.lit(1)), F.lit(n)).cast("int"), F.lit(0))


def type_drift(stored: DataFrame, now: DataFrame) -> DataFrame:
    """(table_name, column_name, stored_type, now_type, drift) of every column whose declared type isn't the same.

    Types are texts like ``decimal(12,2)``.  ADDED and REMOVED columns; WIDENED or NARROWED sizes of one
    type (NARROWED if any size shrinks, the whole digits of a decimal included); otherwise RETYPED.
    """
    a = stored.select("table_name", "column_name", F.lower("value_type").alias("stored_type"))
    b = now.select("table_name", "column_name", F.lower("value_type").alias("now_type"))
    base = [F.regexp_extract(c, r"^\s*(\w+)", 1) for c in ("stored_type", "now_type")]
    p, s = ([_size(c, n) for c in ("stored_type", "now_type")] for n in (1, 2))
    drift = (
        F.when(F.col("stored_type").isNull(), "ADDED")
        .when(F.col("now_type").isNull(), "REMOVED")
        .when(base[0] != base[1], "RETYPED")
        .when((p[1] < p[0]) | (s[1] < s[0]) | (p[1] - s[1] < p[0] - s[0]), "NARROWED")
        .when((p[1] > p[0]) | (s[1] > s[0]), "WIDENED")
    )
    return a.join(b, ["table_name", "column_name"], "full").withColumn("drift", drift).where("drift IS NOT NULL")


COUNTS = ("SourceRows", "TargetRows", "MismatchedRows", "SourceOnlyRows", "TargetOnlyRows")


def result_rows(results: DataFrame, check: str, table: str, source: str, at: str, clean: Column, errors: Column | None = None, metadata: Sequence[str] = ()) -> DataFrame:
    """Rows for the log of reconciliations: PASSED where ``clean``, else ERROR where there are errors, else FAILED.

    Counts that the results don't have are 0; ``metadata`` names columns that are kept as JSON.
    """
    status = F.when(F.coalesce(clean, F.lit(False)), "PASSED")
    if errors is not None:
        status = status.when(errors.isNotNull(), "ERROR")
    meta = F.to_json(F.struct(*metadata)) if metadata else F.lit(None).cast("string")
    return results.select(
        F.lit(table).alias("TableName"), F.lit(source).alias("SourceName"), F.lit(check).alias("CheckType"), _ts(at).alias("RunDate"), status.otherwise("FAILED").alias("Status"),
        *[(F.coalesce(F.col(c), F.lit(0)) if c in results.columns else F.lit(0)).cast("bigint").alias(c) for c in COUNTS],
        meta.alias("Metadata"), (errors if errors is not None else F.lit(None)).cast("string").alias("Errors"),
    )


def retention_preview(vault: DataFrame, provenance: DataFrame, as_of: str) -> DataFrame:
    """(measure, n): tokens whose retention has ended, those of them that are held, and provenance rows of
    tokens that would go and of tokens that the vault doesn't have.

    A token goes if its retention ended before ``as_of``, it is active and not under legal hold.
    """
    over = (F.col("RetentionExpiresAt") < _ts(as_of)) & (F.col("Status") == "active")
    held = F.coalesce(F.col("LegalHold") != 0, F.lit(False))
    goes = F.coalesce(over & ~held, F.lit(False))
    counts = vault.agg(F.count_if(goes).alias("would_purge"), F.count_if(F.coalesce(over & held, F.lit(False))).alias("held"))
    per = provenance.join(vault.groupBy("Token").agg(F.max(goes).alias("__goes")), "Token", "left").agg(
        F.count_if(F.coalesce(F.col("__goes"), F.lit(False))).alias("provenance_follows"), F.count_if(F.col("__goes").isNull()).alias("provenance_without_token")
    )
    return counts.unpivot([], counts.columns, "measure", "n").unionByName(per.unpivot([], per.columns, "measure", "n"))


def import_inventory(config: DataFrame, inventory: DataFrame) -> DataFrame:
    """(SourceName, TableName, verdict, PiiColumnList, DataClassification) of every row of an inventory.

    BAD_CLASS, UNKNOWN_TABLE, UNCHANGED or UPDATED, the first that holds; the values are those that the
    configuration has afterwards.  Values are trimmed, and null and '' are the same.
    """
    keys = ["SourceName", "TableName"]
    want = inventory.select(*keys, *[F.coalesce(F.trim(c), F.lit("")).alias(f"__{c}") for c in ("PiiColumnList", "DataClassification")])
    have = config.select(*keys, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("PiiColumnList", "DataClassification")], F.lit(True).alias("__known"))
    same = (F.col("__PiiColumnList") == F.col("PiiColumnList")) & (F.col("__DataClassification") == F.col("DataClassification"))
    verdict = F.when(~F.col("__DataClassification").isin(*CLASSES), "BAD_CLASS").when(F.col("__known").isNull(), "UNKNOWN_TABLE").when(same, "UNCHANGED").otherwise("UPDATED")
    out = want.join(have, keys, "left").withColumn("verdict", verdict)
    return out.select(*keys, "verdict", *[F.when(F.col("verdict") == "UPDATED", F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in ("PiiColumnList", "DataClassification")])


def missing_keys(keys: DataFrame, columns: DataFrame) -> DataFrame:
    """(table_name, column_name) of configured key columns that their table doesn't have; names match in any case."""
    there = columns.select(F.col("table_name").alias("__t"), F.lower("column_name").alias("__c")).distinct()
    return keys.select("table_name", "column_name").distinct().join(there, (F.col("table_name") == F.col("__t")) & (F.lower("column_name") == F.col("__c")), "left_anti")


def lateness_report(profile: DataFrame, prior: DataFrame, by: Sequence[str], safety: float = 1.5, alarm_above: float = 20.0) -> DataFrame:
    """A lateness profile with what is stored of it: RecommendedLookback, PreviousP99, DriftPct and the alarm.

    The lookback is the 99th percentile times ``safety``, rounded up.  Without an earlier value other than
    0 there is no drift and no alarm; which way it drifts makes no difference.
    """
    before = prior.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("p99").alias("PreviousP99"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    drift = (F.col("p99") - F.col("PreviousP99")) / F.nullif(F.col("PreviousP99"), F.lit(0.0)) * 100
    out = profile.join(before, same, "left").drop(*[f"__{c}" for c in by])
    return out.withColumns({"RecommendedLookback": F.ceil(F.col("p99") * safety).cast("int"), "DriftPct": drift}).withColumn(
        "alarm", F.coalesce(F.abs("DriftPct") > alarm_above, F.lit(False))
    )


def purge_logs(log: DataFrame, at: str, as_of: str, days: dict[str, int], default: int, level: str = "Status") -> DataFrame:
    """The log without rows older than their level's days; rows without a time stay."""
    allowed = F.lit(default)
    for name, n in days.items():
        allowed = F.when(F.col(level) == name, n).otherwise(allowed)
    age = F.datediff(_ts(as_of).cast("date"), F.col(at).cast("date"))
    return log.where(F.coalesce(age <= allowed, F.lit(True)))


def partition_layout(paths: DataFrame, path: str) -> DataFrame:
    """(path, layout): how a table's folders are divided, by the names of partition folders in a file's path.

    hourly, daily, monthly or yearly by the finest part; flat without one.
    """
    low = F.lower(path)

    def part(*names: str) -> Column:
        return low.rlike(f"(^|/)({'|'.join(names)})=")

    layout = (
        F.when(part("hour", "hh"), "hourly").when(part("day", "dd", "date"), "daily").when(part("month", "mm"), "monthly").when(part("year", "yyyy"), "yearly").otherwise("flat")
    )
    return paths.select(path, F.when(F.col(path).isNotNull(), layout).alias("layout"))


def failed_days(runs: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """(keys, day) of days that were tried and failed, and never succeeded, whatever step failed."""
    state = F.upper(F.col("Status"))
    per = runs.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.max(F.coalesce(state.startswith("FAILED"), F.lit(False))).alias("__f"), F.max(F.coalesce(state == "SUCCESS", F.lit(False))).alias("__s"))
    return per.where("__f AND NOT __s").select(*keys, day)


def days_to_process(runs: DataFrame, keys: Sequence[str], day: str, as_of: str, lookback: int, first_load: str | None = None) -> DataFrame:
    """(keys, day, late) of days up to the one before ``as_of`` that have no good run, from the day after the
    last good one or the start of the lookback, whichever is earlier, but not before the first load.

    ``late`` tells that the last good run lies before the lookback.
    """
    end = F.date_sub(F.lit(as_of).cast("date"), 1)
    start = F.date_sub(end, lookback)
    good = runs.where((F.col("Status") == "SUCCESS") & F.col(day).isNotNull()).select(*keys, F.col(day).alias("day")).distinct()
    last = runs.select(*keys).distinct().join(good.groupBy(*keys).agg(F.max("day").alias("__last")), list(keys), "left")
    begin = F.least(F.coalesce(F.date_add("__last", 1), F.lit(first_load).cast("date"), start), start)
    begin = F.greatest(begin, F.lit(first_load).cast("date")) if first_load else begin
    spans = last.withColumns({"__a": begin, "late": F.coalesce(F.datediff(end, F.col("__last")) > lookback, F.lit(False))})
    days = spans.select(*keys, "late", F.explode(F.when(F.col("__a") <= end, F.sequence(F.col("__a"), end, F.expr("INTERVAL 1 DAY")))).alias("day"))
    return days.join(good, [*keys, "day"], "left_anti").select(*keys, "day", "late")
