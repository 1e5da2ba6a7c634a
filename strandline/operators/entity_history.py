"""History of changing attributes by presence bitmaps.

The states and deletes of an entity are its snapshots, numbered in order of time.  For every entity
and state, a bitmap has one bit per snapshot, set where the entity is in that state; a delete, or the
end that a row states for its own version, is a snapshot at which no bit is set.  Every run of
consecutive bits is one version, and gaps need no rule of their own.  States are told apart by the
hash of their texts and by clusters of their number's true values, never by a hash of the number.

Rows are spread by ranges of (entity, time), so an entity with a third of all rows lies in many
partitions.  Inside a partition whole blocks of entities are worked on at once.  Only the entities at
a partition's two edges can continue elsewhere: of these the versions in between are final, and just
their first and last runs (a row per stated end in them) go to a second step that joins the pieces,
by bitmaps as well.  Where a table is cut makes no difference.

Defined results
- Rows with a null key or effective time are no records.
- Of rows with the same key and effective time only that of the greatest surrogate key counts, one
  with a null surrogate key last; equal surrogate keys: the greatest row.
- A row continues the version if its state equals that of the row before it; doubles of any size, NaN
  and infinities included, are equal if they differ by less than 0.000001 or are the same.
- A version ends at the first of: a row with another state (flag 0), a delete (flag 2), the end of
  one of its own rows with flag 2 that is no delete (flag 2).  If a row starts exactly at such an
  end, the version has ended with flag 2 and the row begins a new one.
- A stated end at or before its own row's time has no effect: a version has to last.
- A null operation is no delete.  A delete without an open version does nothing.
- An empty table gives no rows; extra columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.times import micros
from ..functions.values import EPSILON, canonical_string, value_hash
from ..plans.storage import materialise

END, ROW, DELETE, CUT = 0, 1, 2, 3
_EVENT = "p bigint, t bigint, kind int, sh bigint, risk double, origin bigint"
#: Rows that a partition gathers before it works on a block of entities.
BLOCK_ROWS = 100_000


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return (np.isnan(a) & np.isnan(b)) | (a == b) | (np.abs(a - b) < EPSILON)


def bit_runs(group: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive ordinals in each group's bitmap: group, first ordinal, last ordinal.

    Input is sorted by group and ordinal without repeats.
    """
    if not len(group):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ordinal >> 6
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(new)
    bits = np.bitwise_or.reduceat(np.uint64(1) << (ordinal & 63).astype(np.uint64), at)
    g, w = group[at], word[at]
    joined = (g[1:] == g[:-1]) & (w[1:] == w[:-1] + 1)
    before = np.zeros(len(at), np.uint64)
    after = np.zeros(len(at), np.uint64)
    before[1:] = np.where(joined, bits[:-1] >> np.uint64(63), np.uint64(0))
    after[:-1] = np.where(joined, bits[1:] << np.uint64(63), np.uint64(0))
    starts = bits & ~((bits << np.uint64(1)) | before)
    ends = bits & ~((bits >> np.uint64(1)) | after)

    def positions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))

    si, sb = positions(starts)
    ei, eb = positions(ends)
    return g[si], w[si] * 64 + sb, w[ei] * 64 + eb


def _first_of(p: np.ndarray) -> np.ndarray:
    """Index of the first row of each row's entity; rows are sorted by entity."""
    new = np.ones(len(p), bool)
    new[1:] = p[1:] != p[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))


def state_codes(e: dict[str, np.ndarray], real: np.ndarray) -> np.ndarray:
    """A number per event in ``real``: rows that follow each other have the same if they are in one state.

    The rows of an entity and text hash are sorted by their number and clustered where neighbours are
    equal.  Nearly always all values of a cluster are equal to each other; where they drift further
    apart than that, the cluster is divided in order of time.
    """
    if not len(real):
        return np.zeros(0, np.int64)
    p, sh, risk, row = e["p"][real], e["sh"][real], e["risk"][real], e["kind"][real] == ROW
    order = np.lexsort((risk, sh, p))
    ps, ss, rs = p[order], sh[order], risk[order]
    new = np.ones(len(real), bool)
    new[1:] = (ps[1:] != ps[:-1]) | (ss[1:] != ss[:-1]) | ~_near(rs[1:], rs[:-1])
    at = np.flatnonzero(new)
    cluster = np.empty(len(real), np.int64)
    cluster[order] = np.cumsum(new) - 1
    last = np.append(at[1:], len(real)) - 1
    wide = ~_near(rs[at], rs[last])[cluster]
    if not wide.any():
        return cluster
    brk = wide.copy()
    brk[1:] &= ~(row[1:] & row[:-1] & (cluster[1:] == cluster[:-1]) & _near(risk[1:], risk[:-1]))
    return cluster * (len(real) + 1) + np.where(wide, np.cumsum(brk), 0)


def _presence(p: np.ndarray, code: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last event of every version: runs in the bitmaps of each entity's states.

    ``row`` tells which events set a bit; events are sorted by entity and time.
    """
    first = _first_of(p)
    ordinal = np.arange(len(p)) - first
    rows = np.flatnonzero(row)
    rows = rows[np.argsort(code[rows], kind="stable")]
    group = np.unique(code[rows], return_inverse=True)[1] if len(rows) else rows
    g, a, b = bit_runs(group, ordinal[rows])
    new = np.ones(len(rows), bool)
    new[1:] = group[1:] != group[:-1]
    base = first[rows][new][g]
    return base + a, base + b


def versions(e: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Versions of whole entities; events are sorted by entity, time and kind."""
    p, t, kind = e["p"], e["t"], e["kind"]
    real = np.flatnonzero(kind != END)
    if not len(real):
        return {c: np.zeros(0, np.int64) for c in ("p", "b", "e", "flag")}
    rp, rk = p[real], kind[real]
    code = state_codes(e, real)
    keep = np.ones(len(p), bool)
    ends = np.flatnonzero(kind == END)
    if len(ends):
        begins = rk != ROW
        begins[_presence(rp, code, rk == ROW)[0]] = True
        run = np.cumsum(begins)
        # An end holds if the run that its own row is in still lasts; among ends of one run, by time, an end
        # is void if a valid one lies between its row and itself.
        last = np.searchsorted(real, ends) - 1
        times, place = np.unique(np.concatenate([t[real], e["origin"][ends]]), return_inverse=True)
        who = np.unique(np.concatenate([rp, p[ends]]), return_inverse=True)[1]
        rank = who.astype(np.int64) * len(times) + place
        own = np.searchsorted(rank[: len(real)], rank[len(real) :], side="right") - 1
        good = (last >= 0) & (own >= 0) & (rp[own] == p[ends]) & (rp[last] == p[ends]) & (run[last] == run[own]) & (rk[last] == ROW)
        keep[ends[~good]] = False
        ends, of = ends[good], run[last[good]]
        several = np.flatnonzero(np.isin(of, of[1:][of[1:] == of[:-1]])) if len(of) > 1 else []
        reach: dict[int, int] = {}
        for i in several:
            x, r = ends[i], of[i]
            if r in reach and e["origin"][x] < reach[r] <= t[x]:
                keep[x] = False
            else:
                reach[r] = t[x]
    state = np.zeros(len(p), np.int64)
    state[real] = code
    p, t, kind, state = p[keep], t[keep], kind[keep], state[keep]
    begin, last = _presence(p, state, kind == ROW)
    after = last + 1
    ended = after < len(p)
    nxt = np.where(ended, after, begin)
    ended &= p[nxt] == p[begin]
    flag = np.where(ended, np.where((kind[nxt] == ROW) | (kind[nxt] == CUT), 0, 2), 1)
    return {"p": p[begin], "b": t[begin], "e": np.where(ended, t[nxt], 0), "flag": flag}


def edge(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """A piece of one entity: the versions that are final, and the events of its first and last run.

    A row whose version is final but that ends the first run is among the events as a CUT.
    """
    kind = e["kind"]
    real = np.flatnonzero(kind != END)
    code = state_codes(e, real)
    same = np.zeros(len(real), bool)
    if len(real) > 1:
        rows = (kind[real][1:] == ROW) & (kind[real][:-1] == ROW)
        same[1:] = rows & (code[1:] == code[:-1])
    opens = np.ones(len(kind), bool)
    opens[1:] = kind[:-1] == END
    wanted = opens | (kind != ROW)
    changes = real[1:][~same[1:]] if len(real) > 1 else real[:0]
    if len(real) and kind[real[0]] == DELETE:
        changes = np.concatenate([real[:1], changes])
    if len(real):
        # Where a run ends, its last row is what the next row is compared with, in this piece or the next.
        wanted[real[[0, -1]]] = True
    if len(changes) and changes[0] > real[0]:
        wanted[real[np.searchsorted(real, changes[0]) - 1]] = True
    for run in (slice(0, changes[0]), slice(changes[-1], len(kind))) if len(changes) else (slice(0, len(kind)),):
        risk = e["risk"][run][kind[run] == ROW]
        if len(risk) and not _near(risk.max(), risk.min()):
            # Values drift: rows that are left out would make their neighbours look unequal.
            wanted[run] = True
    if not len(changes):
        return versions({k: v[:0] for k, v in e.items()}), {k: v[wanted] for k, v in e.items()}
    a, b = changes[0], changes[-1]
    final = versions({k: v[a : b + 1] for k, v in e.items()})
    done = final["flag"] != 1
    head = np.flatnonzero(wanted[:a])
    tail_wanted = wanted[b:].copy()
    tail_wanted[0] = True
    tail = b + np.flatnonzero(tail_wanted)
    pick = np.concatenate([head, np.array([a]), tail]) if a != b else np.concatenate([head, tail])
    events = {k: v[pick] for k, v in e.items()}
    if a != b and kind[a] == ROW:
        events["kind"] = events["kind"].copy()
        events["kind"][len(head)] = CUT
    return {k: v[done] for k, v in final.items()}, events


_PIECE = "p bigint, a bigint, b bigint, kind int, sh bigint, risk double, origin bigint"


def _pieces(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Versions (kind 10 + flag) and edge events (their kind) of one partition."""

    def as_versions(v: dict[str, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"p": v["p"], "a": v["b"], "b": v["e"], "kind": v["flag"] + 10, "sh": 0, "risk": 0.0, "origin": 0})

    def as_events(v: dict[str, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"p": v["p"], "a": v["t"], "b": 0, "kind": v["kind"], "sh": v["sh"], "risk": v["risk"], "origin": v["origin"]})

    def at_edge(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        final, events = edge({c: pdf[c].to_numpy() for c in pdf.columns})
        yield as_versions(final)
        yield as_events(events)

    held: list[pd.DataFrame] = []
    rows, started = 0, False
    for pdf in it:
        if not len(pdf):
            continue
        held.append(pdf)
        rows += len(pdf)
        if rows < BLOCK_ROWS:
            continue
        block = pd.concat(held, ignore_index=True)
        p = block["p"].to_numpy()
        cut = int(np.searchsorted(p, p[-1]))
        if not started and cut:
            first = int(np.searchsorted(p, p[0], side="right"))
            yield from at_edge(block.iloc[:first])
            started = True
        else:
            first = 0
        if cut > first:
            part = block.iloc[first:cut]
            yield as_versions(versions({c: part[c].to_numpy() for c in part.columns}))
        held = [block.iloc[cut:]]
        rows = len(block) - cut
    if held:
        block = pd.concat(held, ignore_index=True)
        p = block["p"].to_numpy()
        cut = int(np.searchsorted(p, p[-1]))
        first = 0
        if not started and cut:
            first = int(np.searchsorted(p, p[0], side="right"))
            yield from at_edge(block.iloc[:first])
        if cut > first:
            part = block.iloc[first:cut]
            yield as_versions(versions({c: part[c].to_numpy() for c in part.columns}))
        yield from at_edge(block.iloc[cut:])


def _stitch(pdf: pd.DataFrame) -> pd.DataFrame:
    """Versions of one entity from the edge events of its pieces."""
    pdf = pdf.assign(order=np.where(pdf["kind"] == END, 0, 1)).sort_values(["a", "order"], kind="stable")
    found = versions({k: pdf[c].to_numpy() for k, c in (("p", "p"), ("t", "a"), ("kind", "kind"), ("sh", "sh"), ("risk", "risk"), ("origin", "origin"))})
    return pd.DataFrame(found)


def entity_history(
    rows: DataFrame,
    key: str,
    surrogate: str,
    effective: str,
    operation: str,
    end: str,
    flag: str,
    texts: list[str],
    number: str,
) -> DataFrame:
    """(p, b, e, flag): one row per version; times in microseconds, e is 0 while open.

    A state is ``texts`` and the double ``number``.
    """
    deleted = F.coalesce(F.upper(F.trim(F.col(operation))) == "D", F.lit(False))
    number_ = F.col(number)
    states = rows.where(F.col(key).isNotNull() & F.col(effective).isNotNull()).select(
        F.col(key).cast("bigint").alias("p"),
        micros(F.col(effective)).alias("t"),
        F.col(surrogate).alias("k"),
        F.when(deleted, DELETE).otherwise(ROW).alias("kind"),
        F.when(deleted, F.lit(0).cast("bigint"))
        .otherwise(value_hash([*((canonical_string(F.col(c)), rows.schema[c].dataType) for c in texts), (number_.isNull(), rows.schema[texts[0]].dataType)]))
        .alias("sh"),
        F.when(deleted | number_.isNull(), F.lit(0.0)).otherwise(number_.cast("double") + 0.0).alias("risk"),
        F.when(~deleted & (F.col(flag) == 2) & (F.col(end) > F.col(effective)), micros(F.col(end))).alias("end"),
    )
    once = states.groupBy("p", "t").agg(F.max(F.struct("k", "kind", "sh", "risk", "end")).alias("r")).select("p", "t", "r.*")
    events = once.select(
        "p",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct("t", "kind", "sh", "risk", F.lit(0).cast("bigint").alias("origin")),
                    F.when(
                        F.col("end").isNotNull(),
                        F.struct(F.col("end").alias("t"), F.lit(END).alias("kind"), F.lit(0).cast("bigint").alias("sh"), F.lit(0.0).alias("risk"), F.col("t").alias("origin")),
                    ),
                )
            )
        ).alias("x"),
    ).select("p", "x.*")
    order = ["p", "t", "kind"]
    placed = events.repartitionByRange("p", "t").sortWithinPartitions(*order)
    pieces = materialise(placed.mapInPandas(_pieces, _PIECE), "versions")
    final = pieces.where("kind >= 10").select("p", "a", "b", (F.col("kind") - 10).alias("flag"))
    joined = pieces.where("kind < 10").groupBy("p").applyInPandas(_stitch, "p bigint, b bigint, e bigint, flag int")
    return final.select("p", F.col("a").alias("b"), F.col("b").alias("e"), "flag").unionByName(joined)


def person_history(bronze: DataFrame) -> DataFrame:
    """(persnbr, begin_us, end_us, active_flag) of the appended person rows."""
    found = entity_history(
        bronze, "persnbr", "_scd2_key", "UdmEffectiveDateTime", "UdmScd2Operation", "UdmEndDateTime", "UdmActiveFlag",
        ["persname", "segment", "city"], "riskscore",
    )
    return found.select(
        F.col("p").alias("persnbr"), F.col("b").alias("begin_us"), F.col("e").alias("end_us"), F.col("flag").alias("active_flag")
    )
