"""Mixing sources to target weights by whole copies and Pareto order sampling.

A plan wants each source to fill its share of the plan's tokens.  A source's documents are first taken
in whole copies, as often as they fit; what is left of the target is one more copy of some documents.
These are the first in order of their ranking number, the odds of a uniform number divided by the odds
of the document's inclusion probability, that still fit into what is left: a sample of fixed size
with the given, possibly unequal, probabilities.  Last, one further document, or one in place of a
sampled one, is taken if that closes the remaining gap better.

No source is ever sorted in one task.  The ranking numbers are cut into steps of about ``STEP_ROWS``
documents; sums per step, gathered map-side, tell in which step the target is crossed, and all earlier
steps are taken whole.  From there on documents are looked at in order, ``LOOK`` at a time, and taken
if they fit, until no document is left that does.

Defined results
- Sources match after trimming white space and in lower case; a null source matches nothing, but its
  documents count in the plan's total.  A source given twice in a plan has the sum of its weights and
  the larger of its limits; a null weight or limit is 0.
- A plan's total is its fraction of the tokens of all documents.  A source that can't reach its target
  within its limit is used up to the limit; its share isn't given to others.
- Documents without tokens are never chosen.  The uniform numbers are hashes of plan, document and
  seed, so a run can be repeated; equal numbers are ordered by id.  Ids are unique whole numbers.
- Sources without documents have actual share 0.  Empty tables give no documents.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.storage import materialise
from .tokens import encode_documents

#: Documents of a step, about, and the most steps that a source has.
STEP_ROWS, MOST_STEPS = 2048, 1 << 24
#: Documents that are looked at together after the crossing; more are looked at as long as one could fit.
LOOK = 8192
#: Plans and sources are broadcast up to this many rows.
BROADCAST_ROWS = 100_000
_PAIR = ["plan_id", "source"]


def source_name(col: Column) -> Column:
    """The form in which sources match."""
    return F.lower(F.btrim(col, F.lit(" \t\r\n 　")))


def token_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, source, tokens) of all documents."""
    named = docs.select("doc_id", source_name(F.col("source")).alias("source"), "text")
    return encode_documents(named, "text", ["doc_id", "source"]).select("doc_id", "source", F.size("ids").cast("bigint").alias("tokens"))


def _written(df: DataFrame, small: bool) -> DataFrame:
    """A written table with at most a row per plan and source, broadcast if there are few of those."""
    done = materialise(df, "mixture")
    return F.broadcast(done) if small else done


def allocate(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per plan and source: target, whole copies, tokens left to sample, inclusion probability."""
    plans = targets.groupBy("plan_id", source_name(F.col("source")).alias("source")).agg(
        F.sum(F.coalesce("target_weight", F.lit(0.0))).alias("weight"),
        F.max(F.coalesce("max_repeats", F.lit(0))).alias("limit"),
        F.max(F.coalesce("total_fraction", F.lit(0.0))).alias("fraction"),
    )
    have = sizes.groupBy("source").agg(F.sum("tokens").alias("have"), F.count_if(F.col("tokens") > 0).alias("rows"))
    total = sizes.agg(F.sum("tokens").alias("total")).first()["total"] or 0
    joined = plans.join(have, "source", "left")
    have_ = F.coalesce(F.col("have"), F.lit(0))
    plan_total = F.col("fraction") * F.lit(float(total))
    target = F.col("weight") * plan_total
    want = F.least(target, (F.col("limit") * have_).cast("double"))
    whole = F.when(have_ > 0, F.floor(want / have_)).otherwise(0).cast("int")
    out = joined.select(
        *_PAIR, "weight", have_.alias("have"), F.greatest(F.ceil(F.coalesce("rows", F.lit(0)) / STEP_ROWS), F.lit(1)).cast("bigint").alias("steps"), plan_total.alias("plan_total"), target.alias("target_tokens"), want.alias("want"), whole.alias("whole")
    )
    left = F.greatest(F.col("want") - F.col("whole") * F.col("have"), F.lit(0.0))
    return out.withColumn("left", left).withColumn("scale", F.when(F.col("have") > 0, left / F.col("have")).otherwise(0.0))


def _solve(rows: DataFrame, plans: DataFrame, small: bool) -> DataFrame:
    """The scale at which min(1, scale * weight) gives the wanted tokens, where weights are unequal.

    From scale 0 on, the set of certain documents only grows; the scale holds once it grows no more.
    """
    plans, settled, before = plans.withColumn("scale", F.lit(0.0)), False, -1
    while not settled:
        certain = F.col("scale") * F.col("w") >= 1
        sums = rows.join(plans.select(*_PAIR, "scale"), _PAIR).groupBy(*_PAIR).agg(
            F.sum(F.when(certain, F.col("tokens")).otherwise(0)).alias("sure"),
            F.sum(F.when(~certain, F.col("tokens") * F.col("w")).otherwise(0.0)).alias("free"),
            F.count_if(certain).alias("certain"),
        )
        nxt = F.when(F.col("free") > 0, (F.col("left") - F.col("sure")) / F.col("free")).otherwise(F.col("scale"))
        # No scale is below an earlier one but by rounding.
        plans = _written(plans.drop("certain").join(sums, _PAIR, "left").withColumn("scale", F.greatest(nxt, "scale")).drop("sure", "free"), small)
        now = plans.agg(F.sum("certain").alias("n")).first()["n"] or 0
        settled, before = now <= before, now
    return plans.drop("certain")


def _crossing(ranked: DataFrame, plans: DataFrame) -> DataFrame:
    """Per plan and source with something left: the step that crosses it (null if all fits), and what is left before that step."""
    sums = ranked.groupBy(*_PAIR, "step").agg(F.sum("tokens").alias("tokens"))
    run = sums.withColumn("upto", F.sum("tokens").over(Window.partitionBy(*_PAIR).orderBy("step")))
    inside = F.col("upto") <= F.col("left")
    reach = run.join(plans.select(*_PAIR, "left"), _PAIR).groupBy(*_PAIR).agg(
        F.max(F.when(inside, F.col("upto"))).alias("before"), F.min(F.when(~inside, F.col("step"))).alias("cross")
    )
    return plans.select(*_PAIR, "left").join(reach, _PAIR, "left").select(*_PAIR, "cross", (F.col("left") - F.coalesce("before", F.lit(0))).alias("gap"))


def _first_fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of one plan and source that fit, in order; the last row, without a document, has the
    place that was reached, what is left, and whether more may follow."""
    pdf = pdf.sort_values(["place", "doc_id"], kind="stable")
    gap, taken = float(pdf["gap"].iloc[0]), []
    for i, t in enumerate(pdf["tokens"].tolist()):
        if t <= gap:
            gap -= t
            taken.append(i)
    last = pdf.iloc[-1]
    rows = [(int(pdf["doc_id"].iloc[i]), None, None, None, None) for i in taken]
    rows.append((None, float(last["place"]), int(last["doc_id"]), gap, len(pdf) == LOOK and gap > 0))
    out = pd.DataFrame(rows, columns=["doc_id", "at_place", "at_doc", "gap", "more"])
    out[["doc_id", "at_doc"]] = out[["doc_id", "at_doc"]].astype("Int64")
    out.insert(0, "plan_id", last["plan_id"])
    out.insert(1, "source", last["source"])
    return out


def _fill(ranked: DataFrame, crossing: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """(plan_id, source, doc_id) taken from the crossing step on, and (plan_id, source, gap) in the end."""
    place = ranked.schema["plan_id"].dataType.simpleString()
    schema = f"plan_id {place}, source string, doc_id bigint, at_place double, at_doc bigint, gap double, more boolean"
    at = crossing.where("cross IS NOT NULL").select(*_PAIR, "gap", F.col("cross").alias("from_step"), F.lit(-1.0).alias("at_place"), F.lit(None).cast("bigint").alias("at_doc"))
    taken, ends, turn = [], [], 0
    order = Window.partitionBy(*_PAIR).orderBy("place", "doc_id")
    while True:
        beyond = (F.col("place") > F.col("at_place")) | ((F.col("place") == F.col("at_place")) & (F.col("doc_id") > F.col("at_doc")))
        rows = ranked.join(at, _PAIR).where((F.col("step") >= F.col("from_step")) & (F.col("tokens") <= F.col("gap")) & beyond)
        near = rows.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= LOOK).select(*_PAIR, "doc_id", "tokens", "place", "gap")
        found = materialise(near.groupBy(*_PAIR).applyInPandas(_first_fit, schema), "mixture")
        taken.append(found.where("doc_id IS NOT NULL").select(*_PAIR, "doc_id"))
        ends.append(found.where("doc_id IS NULL").select(*_PAIR, "gap", F.lit(turn).alias("turn")))
        turn += 1
        more = found.where("more")
        if not more.limit(1).count():
            break
        at = more.select(*_PAIR, "gap", F.lit(0).cast("bigint").alias("from_step"), "at_place", "at_doc")
        at = F.broadcast(at) if small else at
    gaps = crossing.select(*_PAIR, "gap", F.lit(-1).alias("turn"))
    for e in ends:
        gaps = gaps.unionByName(e)
    gaps = gaps.groupBy(*_PAIR).agg(F.max_by("gap", "turn").alias("gap"))
    return reduce(DataFrame.unionByName, taken), gaps


def _close(marked: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per plan and source: the document more and the one it replaces (null if there is none) that come
    nearest to the gap, if that is nearer than nothing.

    Sizes stand for documents, so what is sorted is at most as long as the longest document.
    """
    rows = marked.join(gaps.where("gap > 0"), _PAIR).groupBy(*_PAIR, "gap", "tokens").agg(
        F.min(F.when(~F.col("taken"), F.struct("place", "doc_id"))).alias("y"), F.max(F.when(F.col("taken"), F.struct("place", "doc_id"))).alias("x")
    )
    size = F.col("tokens").cast("double")
    # A free size stands where it would close the gap by itself; a held one where a free one would have to be to take its place.
    points = rows.select(*_PAIR, "gap", F.explode(F.array_compact(F.array(
        F.when(F.col("y").isNotNull(), F.struct(size.alias("at"), F.struct(size.alias("tokens"), F.col("y.doc_id").alias("doc_id")).alias("f"), F.lit(None).cast("double").alias("less"), F.lit(None).cast("bigint").alias("drop"))),
        F.when(F.col("x").isNotNull(), F.struct((size + F.col("gap")).alias("at"), F.lit(None).cast("struct<tokens: double, doc_id: bigint>").alias("f"), size.alias("less"), F.col("x.doc_id").alias("drop"))),
    ))).alias("p")).select(*_PAIR, "gap", "p.*")
    seen = [F.last("f", ignorenulls=True).over(Window.partitionBy(*_PAIR).orderBy(o).rangeBetween(Window.unboundedPreceding, 0)) for o in (F.asc("at"), F.desc("at"))]
    near = points.withColumn("near", F.array_compact(F.array(*seen)))
    tries = near.select(*_PAIR, "gap", "less", "drop", F.explode(F.when(F.col("less").isNull(), F.array("f")).otherwise(F.col("near"))).alias("f")).select(
        *_PAIR, "gap", F.abs(F.col("gap") - (F.col("f.tokens") - F.coalesce("less", F.lit(0.0)))).alias("off"), F.col("less").isNotNull().alias("swap"), F.col("f.doc_id").alias("fill"), "drop"
    )
    return tries.where("off < gap").groupBy(*_PAIR).agg(F.min(F.struct("off", "swap", "fill", "drop")).alias("b")).select(*_PAIR, "b.fill", "b.drop")


def choose(sizes: DataFrame, targets: DataFrame, seed: int = 20240613, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(plan_id, source, doc_id, tokens, uses) of the chosen documents, and the allocation.

    ``sizes`` has doc_id, source and tokens, and ``weight`` names its column of relative inclusion
    weights, equal if there is none; it is read several times, so it should be a written table.
    """
    plans = materialise(allocate(sizes, targets), "mixture")
    small = plans.count() <= BROADCAST_ROWS
    plans = F.broadcast(plans) if small else plans
    w = F.col(weight) if weight else F.lit(1.0)
    rows = sizes.where("tokens > 0 AND source IS NOT NULL").select("source", "doc_id", "tokens", F.greatest(w.cast("double"), F.lit(1e-12)).alias("w"))
    rows = rows.join(plans.where("have > 0").select(*_PAIR, "whole"), "source")
    if weight:
        plans = _solve(rows, plans, small)
    chance = F.least(F.col("scale") * F.col("w"), F.lit(1.0 - 1e-12))
    u = (F.pmod(F.xxhash64("plan_id", "doc_id", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) * (1 - F.col("chance")) / F.col("chance")
    # Ranking numbers are spread evenly over the steps where all odds are equal; with unequal ones steps differ in size.
    steps = F.least(F.col("steps"), F.lit(MOST_STEPS))
    ranked = (
        rows.join(plans.select(*_PAIR, "scale", "left", "steps"), _PAIR)
        .withColumn("chance", chance)
        .withColumn("place", F.when((F.col("chance") > 0) & (F.col("left") > 0), odds / (1 + odds)))
        .withColumn("step", F.floor(F.col("place") * steps).cast("bigint"))
        .select(*_PAIR, "doc_id", "tokens", "whole", "place", "step")
    )
    ranked = materialise(ranked, "ranked")
    live = ranked.where("place IS NOT NULL")
    crossing = _written(_crossing(live, plans), small)
    taken, gaps = _fill(live, crossing, small)
    taken = taken.withColumn("__taken", F.lit(True))
    marked = live.join(crossing.select(*_PAIR, "cross"), _PAIR).join(taken, [*_PAIR, "doc_id"], "left")
    marked = marked.withColumn("taken", F.col("__taken").isNotNull() | F.coalesce(F.col("step") < F.col("cross"), F.lit(True))).select(*_PAIR, "doc_id", "tokens", "place", "taken")
    changes = _written(_close(marked, gaps), small)
    picked = ranked.join(crossing.select(*_PAIR, "cross"), _PAIR, "left").join(changes, _PAIR, "left").join(taken, [*_PAIR, "doc_id"], "left")
    kept = F.col("place").isNotNull() & (F.col("__taken").isNotNull() | F.coalesce(F.col("step") < F.col("cross"), F.col("cross").isNull())) & F.coalesce(F.col("doc_id") != F.col("drop"), F.lit(True))
    uses = F.col("whole") + (kept | F.coalesce(F.col("doc_id") == F.col("fill"), F.lit(False))).cast("int")
    return picked.select(*_PAIR, "doc_id", "tokens", uses.alias("uses")).where("uses > 0"), plans


def shares(chosen: DataFrame, plans: DataFrame) -> DataFrame:
    """Target and actual share of the plan's total, per plan and source."""
    got = chosen.groupBy(*_PAIR).agg(
        F.sum(F.col("tokens") * F.col("uses")).alias("got"), F.count("*").alias("documents"), F.max("uses").alias("most_uses")
    )
    got_ = F.coalesce("got", F.lit(0))
    return plans.join(got, _PAIR, "left").select(
        *_PAIR,
        F.col("weight").alias("target_share"),
        F.when(F.col("plan_total") > 0, got_ / F.col("plan_total")).otherwise(0.0).alias("actual_share"),
        "target_tokens",
        got_.alias("actual_tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
    )


def mix(docs: DataFrame, targets: DataFrame, by_size: bool = False) -> tuple[DataFrame, DataFrame]:
    """Chosen documents and shares of every plan; with ``by_size`` a document's inclusion odds follow the
    square root of its size, so long ones are taken more often."""
    sizes = materialise(token_counts(docs), "tokens")
    if by_size:
        sizes = sizes.withColumn("weight", F.sqrt("tokens"))
    chosen, plans = choose(sizes, targets, weight="weight" if by_size else None)
    return chosen, shares(chosen, plans)
