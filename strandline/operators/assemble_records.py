"""Records of delimited files, put together from lines with regard to quotes.

A line break inside a quoted field belongs to the record; any other ends it.  Whether a line begins
inside a quoted field depends on all lines before it, so the files' splits are gone through twice.
First each split is read as if it began outside of quotes and as if it began inside, which gives a
split's effect in two bits; one row per split is carried along its file.  Then every split is cut into
records, knowing how it begins, and a record that crosses splits is joined from its pieces.  No task
reads more than its split, and a file of any size is read by many tasks.

A quote that is never closed would swallow good records up to the next quote.  So a record of several
lines whose quotes don't hold is divided again: its first line comes out alone, as a record that
can't be loaded, and the lines after it are put together anew.

Defined results
- Lines end with LF; a CR before it is kept, and belongs to the line end that a record may have.
- A quote opens a field only as its first character; elsewhere it is an ordinary character, which the
  reader of the records will refuse.
- ``first_line`` counts from 0 inside the split that a record begins in; (file, split, first_line) tells
  records apart.  Blank lines outside of quotes are empty records.  An empty file has none.
- The last line counts whether or not it ends with LF.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..plans.storage import materialise
from .reject_records import judge_records

#: Splits whose beginnings are broadcast, each a path and two numbers; beyond it they are joined and the lines sorted again.
SPLITS = 100_000
OUTSIDE, INSIDE = 0, 1


def scan(line: str, delimiter: str, state: int) -> int:
    """Whether the text after a line, which begins in ``state``, is inside a quoted field."""
    if '"' not in line:
        return state
    at, n = 0, len(line)
    while True:
        if state == INSIDE:
            while True:
                at = line.find('"', at)
                if at < 0:
                    return INSIDE
                if at + 1 < n and line[at + 1] == '"':
                    at += 2
                    continue
                break
            at += 1
            state = OUTSIDE
        elif at < n and line[at] == '"':
            state = INSIDE
            at += 1
            continue
        # Outside, at something other than a field's beginning: the next field begins after a delimiter.
        at = line.find(delimiter, at)
        if at < 0:
            return OUTSIDE
        at += 1


def holds(record: str, delimiter: str) -> bool:
    """Whether every quoted field is closed directly before a delimiter or the end, and no other field has a quote."""
    text = record[:-1] if record.endswith("\r") else record
    at, n = 0, len(text)
    while True:
        if at < n and text[at] == '"':
            at += 1
            while True:
                at = text.find('"', at)
                if at < 0:
                    return False
                if at + 1 < n and text[at + 1] == '"':
                    at += 2
                    continue
                break
            at += 1
            if at < n and text[at] != delimiter:
                return False
        else:
            to = text.find(delimiter, at)
            to = n if to < 0 else to
            if '"' in text[at:to]:
                return False
            at = to
        if at >= n:
            return True
        at += 1


def divide(lines: list[str], delimiter: str) -> list[tuple[int, str]]:
    """(first line, record) of lines that begin outside of quotes; what is open at the end is a record too."""
    out, start = [], 0
    while start < len(lines):
        state, end = OUTSIDE, start
        while end < len(lines):
            state = scan(lines[end], delimiter, state)
            end += 1
            if state == OUTSIDE:
                break
        text = "\n".join(lines[start:end])
        if end - start > 1 and not holds(text, delimiter):
            out.append((start, lines[start]))
            start += 1
            continue
        out.append((start, text))
        start = end
    return out


def assemble(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """(file, split, first_line, record) of the files at the path."""
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("i"))

    def effects(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: list | None = None
        for pdf in it:
            for value, file, split in zip(pdf["value"], pdf["file"], pdf["split"], strict=True):
                if now is None or now[:2] != [file, split]:
                    if now:
                        yield pd.DataFrame([now], columns=["file", "split", "out", "ins"])
                    now = [file, split, OUTSIDE, INSIDE]
                now[2], now[3] = scan(value, delimiter, now[2]), scan(value, delimiter, now[3])
        if now:
            yield pd.DataFrame([now], columns=["file", "split", "out", "ins"])

    found = lines.drop("i").mapInPandas(effects, "file string, split bigint, out int, ins int")
    # A split fixes the state after it, or turns it, or leaves it alone: what counts is the last split that
    # fixed it and how many have turned it since.
    upto = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    turned = found.withColumn("turns", F.sum(F.when((F.col("out") == INSIDE) & (F.col("ins") == OUTSIDE), 1).otherwise(0)).over(upto))
    fixed = F.last(F.when(F.col("out") == F.col("ins"), F.struct("out", "turns")), ignorenulls=True).over(before)
    carried = turned.withColumns({"fixed": fixed, "so_far": F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("split")), F.lit(0))})
    state = F.coalesce(F.col("fixed.out"), F.lit(OUTSIDE)) + F.col("so_far") - F.coalesce(F.col("fixed.turns"), F.lit(0))
    begins = materialise(carried.select("file", "split", F.pmod(state, F.lit(2)).cast("int").alias("begins")), "splits")
    if begins.count() <= SPLITS:
        known = lines.join(F.broadcast(begins), ["file", "split"])
    else:
        known = lines.join(begins.hint("shuffle_hash"), ["file", "split"]).repartition("file", "split").sortWithinPartitions("file", "split", "i")

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pieces of records: whole lines of one record in this split; ``part`` tells the ones that go on or come from before."""
        key, state, number, held, start = None, OUTSIDE, 0, [], 0
        rows: list[tuple] = []

        def flush(open_end: bool) -> None:
            if held:
                rows.append((*key, start, "\n".join(held), start < 0, open_end))

        for pdf in it:
            for value, file, split, begins_in in zip(pdf["value"], pdf["file"], pdf["split"], pdf["begins"], strict=True):
                if key != (file, split):
                    flush(state == INSIDE)
                    key, state, number, held = (file, split), int(begins_in), 0, []
                    start = -1 if state == INSIDE else 0
                held.append(value)
                state = scan(value, delimiter, state)
                number += 1
                if state == OUTSIDE:
                    flush(False)
                    held, start = [], number
            yield pd.DataFrame(rows, columns=["file", "split", "first_line", "piece", "comes", "goes"])
            rows = []
        flush(state == INSIDE)
        yield pd.DataFrame(rows, columns=["file", "split", "first_line", "piece", "comes", "goes"])

    pieces = known.mapInPandas(cut, "file string, split bigint, first_line int, piece string, comes boolean, goes boolean")

    def again(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for file, split, first, text in zip(pdf["file"], pdf["split"], pdf["first_line"], pdf["record"], strict=True):
                out += [(file, split, first + i, r) for i, r in divide(text.split("\n"), delimiter)]
            yield pd.DataFrame(out, columns=["file", "split", "first_line", "record"])

    whole = pieces.where("NOT comes AND NOT goes").select("file", "split", "first_line", F.col("piece").alias("record"))
    # Pieces of records that cross splits: few per split, ordered along their file.
    over = pieces.where("comes OR goes")
    along = Window.partitionBy("file").orderBy("split", "first_line")
    numbered = over.withColumn("head", F.sum((~F.col("comes")).cast("int")).over(along))
    joined = numbered.groupBy("file", "head").agg(F.sort_array(F.collect_list(F.struct("split", "first_line", "piece"))).alias("all"))
    crossing = joined.select(
        "file", F.col("all")[0]["split"].alias("split"), F.col("all")[0]["first_line"].alias("first_line"), F.array_join(F.transform("all", lambda x: x["piece"]), "\n").alias("record")
    )
    return whole.unionByName(crossing).mapInPandas(again, "file string, split bigint, first_line int, record string")



def judge_files(spark: SparkSession, path: str, file_layout: DataFrame, table: str) -> DataFrame:
    """(place, reason, column_name, fields) of every record of a table's files; reason is null if it loads.

    ``place`` is the file, the split and the line where the record begins.
    """
    # The layout is configuration; its delimiter is needed to plan.
    row = file_layout.where(F.col("table_name") == table).select("delimiter").first()
    if row is None:
        raise ValueError(f"no layout of {table}")
    records = assemble(spark, path, row["delimiter"])
    placed = records.select(F.concat_ws(":", "file", "split", "first_line").alias("place"), F.lit(table).alias("table"), "record")
    return judge_records(placed, file_layout, "place", "table", "record").drop("table")
