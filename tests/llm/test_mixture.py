import random
from collections import defaultdict

import pytest

from strandline.llm import mixture as mx

TARGETS = "plan_id int, source string, target_weight double, max_repeats int, total_fraction double"


def sizes(spark, seed=1, n=3000):
    r = random.Random(seed)
    # One source holds more than a third of the documents; some documents have no tokens or source.
    rows = [(i, r.choice(["big", "big", "mid", "small", None]), 0 if r.random() < 0.05 else int(r.lognormvariate(5, 1)) + 1) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint"), rows


def test_shares_and_limits(spark):
    df, rows = sizes(spark)
    total = sum(r[2] for r in rows)
    have = defaultdict(int)
    for _, s, t in rows:
        have[s] += t
    plan = [(1, " BIG ", 0.3, 1, 0.5), (1, "mid", 0.6, 2, 0.5), (1, "small", 0.1, 9, 0.5), (2, "small", 1.0, 3, 1.0), (2, "none", 0.5, 3, 1.0), (3, "mid", None, 3, 1.0), (3, "big", 0.1, None, 1.0)]
    chosen, plans = mx.choose(df, spark.createDataFrame(plan, TARGETS))
    got = chosen.collect()
    assert len(got) == len({(r["plan_id"], r["doc_id"]) for r in got})
    limit = {(p, s.strip().lower()): m or 0 for p, s, _, m, _ in plan}
    used = defaultdict(int)
    by = {r[0]: r for r in rows}
    for r in got:
        assert 0 < r["uses"] <= limit[r["plan_id"], r["source"]] and by[r["doc_id"]][1] == r["source"] and r["tokens"] > 0
        used[r["plan_id"], r["source"]] += r["uses"] * r["tokens"]
    for p, s, w, m, f in plan:
        s = s.strip().lower()
        want = min((w or 0) * f * total, (m or 0) * have.get(s, 0))
        assert abs(used[p, s] - want) <= 3, (p, s)
    shares = {(r["plan_id"], r["source"]): r for r in mx.shares(chosen, plans).collect()}
    assert len(shares) == len(plan) and shares[2, "none"]["actual_share"] == 0
    assert shares[1, "big"]["actual_share"] == pytest.approx(used[1, "big"] / (0.5 * total))
    again = {(r["plan_id"], r["doc_id"], r["uses"]) for r in mx.choose(df.repartition(7), spark.createDataFrame(plan, TARGETS))[0].collect()}
    assert again == {(r["plan_id"], r["doc_id"], r["uses"]) for r in got}


def test_a_long_document_at_the_target_leaves_no_gap(spark):
    # A document of 9,000 tokens crosses the target early; short documents that fit are left.
    rows = [(i, "a", 9000) for i in range(8)] + [(100 + i, "a", 1 + i * 7 % 60) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    total = sum(r[2] for r in rows)
    for seed in range(2):
        got = mx.choose(df, spark.createDataFrame([(1, "a", 0.05, 1, 1.0)], TARGETS), seed=seed)[0].collect()
        assert len({r["doc_id"] for r in got}) == len(got)
        assert abs(sum(r["tokens"] * r["uses"] for r in got) - 0.05 * total) <= 3, seed


def test_unequal_weights(spark):
    df, rows = sizes(spark, 2)
    df = df.selectExpr("*", "CASE WHEN doc_id % 2 = 0 THEN 4.0 ELSE 1.0 END AS w")
    target = spark.createDataFrame([(1, "big", 0.08, 1, 1.0)], TARGETS)
    chosen = mx.choose(df, target, weight="w")[0].collect()
    want = 0.08 * sum(r[2] for r in rows)
    assert abs(sum(r["tokens"] for r in chosen) - want) <= 3
    even = sum(r["doc_id"] % 2 == 0 for r in chosen)
    assert even > 2 * (len(chosen) - even)


def test_scale_of_very_unequal_weights(spark):
    rows = [(i, 1, "a", 10, 4.0**i) for i in range(41)]
    df = spark.createDataFrame(rows, "doc_id bigint, plan_id int, source string, tokens bigint, w double")
    plans = spark.createDataFrame([(1, "a", 205.0, 0.5)], "plan_id int, source string, left double, scale double")
    scale = mx._solve(df, plans, True).first()["scale"]
    assert sum(t * min(1.0, scale * w) for _, _, _, t, w in rows) == pytest.approx(205)


def test_equal_chances(spark):
    df, rows = sizes(spark, 3, 400)
    target = spark.createDataFrame([(1, "big", 0.2, 1, 1.0)], TARGETS)
    seen = defaultdict(int)
    for seed in range(5):
        for r in mx.choose(df, target, seed=seed)[0].collect():
            seen[r["doc_id"]] += 1
    big = [i for i, s, t in rows if s == "big" and t]
    assert sum(seen[i] > 0 for i in big) > 0.6 * len(big)


def test_documents_and_empty(spark):
    docs = spark.createDataFrame([(1, "a few words here", "X ", 1), (2, None, "x", 1), (3, "", "x", 1), (4, "more words", None, 1)], "doc_id bigint, text string, source string, tokens int")
    target = spark.createDataFrame([(1, "x", 1.0, 2, 1.0)], TARGETS)
    chosen, shares = mx.mix(docs, target)
    assert [(r["doc_id"], r["uses"]) for r in chosen.collect()] in ([(1, 1)], [(1, 2)])
    assert shares.count() == 1
    chosen, shares = mx.mix(docs.limit(0), target)
    assert chosen.count() == 0 and shares.first()["actual_share"] == 0
    assert mx.mix(docs, target.limit(0))[0].count() == 0
