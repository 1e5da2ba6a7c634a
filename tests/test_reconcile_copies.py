import datetime as dt
import random
import unicodedata

import numpy as np

from strandline.operators import reconcile_copies as rc

SCHEMA = (
    "batch_id bigint, acctnbr bigint, branchnbr int, mjaccttypcd string, acctstatcd string, acctname string, curbal double, intrate double, "
    "opendate date, note string, __k string"
)
LOG = "Id bigint, BatchId bigint, RunDate timestamp_ntz, SourceRows int, TargetRows int, MismatchedRows int, SourceOnlyRows int, TargetOnlyRows int"


def row(r, batch, acct):
    return [batch, acct, r.choice([1, 2, None]), r.choice(["A", None, ""]), "S", r.choice(["José", "Ann"]), r.choice([0.0, 1.5, float("nan"), None]), 0.5, r.choice([None, dt.date(2020, 1, 1)]), "n", "x"]


def copies(seed, n, change):
    r = random.Random(seed)
    s, t = [], []
    for i in range(n):
        # One batch holds a third of all rows and more than a bucket.
        a = row(r, 1 if i % 3 == 0 else r.randrange(2, 6), i)
        if r.random() < 0.02:
            a[1] = None
        b = list(a)
        b[5] = unicodedata.normalize("NFD", b[5]) + "  "
        b[6] = -0.0 if b[6] == 0.0 else b[6]
        b[7] += 3e-7
        if r.random() < change:
            k = r.choice([2, 5, 6])
            b[k] = {2: 9, 5: "jose", 6: 8.25}[k]
        p = r.random()
        if p > 0.03:
            s.append(a)
        if not 0.03 < p < 0.06:
            t.append(b)
        for side, x in ((s, a), (t, b)):
            if side and side[-1] is x and r.random() < 0.1:
                side.extend([list(x)] * r.randrange(1, 4))
    return s, t


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float):
        return (a != a and b != b) or abs(a - b) < 1e-6
    if isinstance(a, str):
        n = [unicodedata.normalize("NFC", x).rstrip(" ") for x in (a, b)]
        return n[0] == n[1]
    return a == b


def brute(s, t):
    names = ["branchnbr", "mjaccttypcd", "acctstatcd", "acctname", "curbal", "intrate", "opendate", "note"]
    a = {(x[0], x[1]): x for x in s if x[1] is not None}
    b = {(x[0], x[1]): x for x in t if x[1] is not None}
    out = {(*k, "source_only") for k in a.keys() - b.keys()} | {(*k, "target_only") for k in b.keys() - a.keys()}
    for k in a.keys() & b.keys():
        out |= {(*k, n) for i, n in enumerate(names) if not same(a[k][i + 2], b[k][i + 2])}
    return out, a, b


def check(spark, s, t, log=()):
    frames = [spark.createDataFrame([tuple(x) for x in y], SCHEMA) for y in (s, t)]
    got = [tuple(r) for r in rc.account_findings(spark, *frames, spark.createDataFrame(list(log), LOG)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_few_and_many_differences(spark):
    # With half of the rows changed, buckets don't peel and are compared whole.
    for change in (0.05, 0.5):
        s, t = copies(3, 900, change)
        assert check(spark, s, t) == brute(s, t)[0]


def test_repeats_that_contradict_each_other(spark):
    a = [1, 5, 1, "A", "S", "Ann", 1.5, 0.5, None, "n", "x"]
    b = [1, 5, 2, *a[3:]]
    assert check(spark, [a, b], [b, a, a]) == set()
    assert check(spark, [a, b], [a]) == {(1, 5, "branchnbr")}


def test_one_key_repeated_for_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(rc, "THIN_ROWS", 50)
    s, t = copies(7, 200, 0.1)
    s, t = s + [s[3]] * 150, [x for x in t if x[:2] != s[3][:2]]
    want, a, b = brute(s, t)
    day = dt.datetime(2026, 1, 1)
    n = [sum(k[0] == s[3][0] for k in x) for x in (a, b)]
    found = check(spark, s, t, [(1, s[3][0], day, n[0], n[1], -1, 0, 0)])
    assert {x for x in found if x[1] != -1} == want
    assert not {x[2] for x in found if x[1] == -1} & {"SourceRows", "TargetRows"}


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(rc, "BROADCAST_ROWS", -1)
    s, t = copies(4, 500, 0.1)
    assert check(spark, s, t) == brute(s, t)[0]


def test_log_counts(spark):
    s, t = copies(5, 300, 0.1)
    want, a, b = brute(s, t)
    n = len([k for k in a if k[0] == 1])
    day = dt.datetime(2026, 1, 1)
    log = [(1, 1, day, 0, 0, 0, 0, 0), (2, 1, day + dt.timedelta(1), n, None, -1, 0, 0), (2, 1, day + dt.timedelta(1), n, None, -1, 0, 0), (3, 77, day, 0, 0, 1, 0, 0), (4, None, day, 1, 1, 1, 1, 1)]
    got = {x for x in check(spark, s, t, log) if x[1] == -1}
    assert (1, -1, "SourceRows") not in got and (1, -1, "TargetRows") in got and (1, -1, "MismatchedRows") in got
    assert {x for x in got if x[0] == 77} == {(77, -1, "MismatchedRows")}
    assert not {x for x in got if x[0] not in (1, 77)}


def test_empty(spark):
    assert check(spark, [], []) == set()
    s, _ = copies(6, 40, 0)
    assert check(spark, s, []) == brute(s, [])[0]


def test_changed_rows_peel(spark, monkeypatch):
    # Both pairs of a changed key are in the tables; only the changed keys are fetched, not their buckets.
    s, t = copies(8, 600, 0.08)
    want, a, b = brute(s, t)
    seen = {}
    real = rc.materialise
    monkeypatch.setattr(rc, "materialise", lambda df, name: seen.setdefault(name, real(df, name)))
    assert check(spark, s, t) == want
    peeled = seen["peeled"].where("__suspect")
    assert peeled.where("__key IS NULL").count() == 0
    assert peeled.select("__bucket", "__sub", "__key").distinct().count() == len({x[:2] for x in want})


def test_peel_reveals_repeated_pairs():
    rng = np.random.default_rng(0)
    k, h = rng.integers(-(1 << 63), 1 << 63, (2, 8), dtype=np.int64)
    m = np.array([1, -1, 2, -3, 1, 1, -2, 5])
    cells = {}
    for i in range(8):
        for j in range(3):
            c = cells.setdefault(int(rc._np_slot(k[i] ^ h[i], j)), dict.fromkeys(("n", "kl", "kh", "hl", "hh", "ck"), 0))
            for f, v in zip(c, (1, k[i] & rc._LOW, k[i] >> 32, h[i] & rc._LOW, h[i] >> 32, rc._np_check(k[i], h[i])), strict=True):
                c[f] += int(v) * int(m[i])
    cells = {s: c for s, c in cells.items() if any(c.values())}
    arrays = {f: np.array([c[f] for c in cells.values()]) for f in ("n", "kl", "kh", "hl", "hh", "ck")} | {"slot": np.array(list(cells))}
    _, keys, clean = rc.peel(np.zeros(len(cells), np.int64), arrays)
    assert clean.all() and sorted(keys.tolist()) == sorted(k.tolist())
