import random
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings, strategies as st

from strandline.operators import entity_history as eh

SCHEMA = (
    "_scd2_key bigint, persnbr bigint, persname string, segment string, city string, riskscore double, UdmEffectiveDateTime timestamp_ntz, "
    "UdmEndDateTime timestamp_ntz, UdmActiveFlag tinyint, UdmScd2Operation string, kind string"
)
T0 = datetime(2024, 1, 1)


def brute(rows):
    best = {}
    for r in rows:
        if r[1] is not None and r[6] is not None:
            k = (r[1], r[6])
            if k not in best or (r[0] is not None, r[0] or 0) > (best[k][0] is not None, best[k][0] or 0):
                best[k] = r
    out, now, who = [], None, None
    us = lambda t: (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)

    def close(end, flag):
        nonlocal now
        out.append((who, us(now[0]), us(end) if end else 0, flag))
        now = None

    def finish():
        if now:
            close(now[2], 2) if now[2] else close(None, 1)

    for (p, t), r in sorted(best.items()):
        if p != who:
            finish()
            who = p
        if now and now[2] and now[2] <= t:
            close(now[2], 2)
        if (r[9] or "").strip().upper() == "D":
            if now:
                close(t, 2)
            continue
        risk = r[5]
        state = (r[2], r[3], r[4])
        if now:
            a, b = now[1][1], risk
            same = (a is b) if a is None or b is None else (a != a and b != b) or a == b or abs(a - b) < 1e-6
            if now[1][0] != state or not same:
                close(t, 0)
        if not now:
            now = [t, (state, risk), None]
        if r[8] == 2 and r[7] and r[7] > t:
            now[2] = min(now[2] or r[7], r[7])
    finish()
    return sorted(out)


def walk(events):
    """Versions of one entity, event by event: (begin, end, flag)."""
    out, begin, sh, risk = [], None, 0, 0.0
    for t, kind, h, r, origin in events:
        if kind == eh.ROW:
            same = begin is not None and h == sh and (r == risk or abs(r - risk) < eh.EPSILON or (r != r and risk != risk))
            sh, risk = h, r
            if same:
                continue
            if begin is not None:
                out.append((begin, t, 0))
            begin = t
        elif begin is not None and (kind != eh.END or begin <= origin):
            out.append((begin, t, 0 if kind == eh.CUT else 2))
            begin = None
    if begin is not None:
        out.append((begin, 0, 1))
    return out


def rows(seed, n, people):
    r = random.Random(seed)
    out = []
    for i in range(n):
        p = 1 if r.random() < 0.33 else r.randrange(people)
        t = T0 + timedelta(hours=r.randrange(60))
        flag = r.choice([0, 1, 1, 2, None])
        end = r.choice([None, t + timedelta(hours=r.randrange(-3, 30)), datetime(2999, 12, 31)])
        out.append(
            (i, None if r.random() < 0.03 else p, r.choice(["a", "b"]), None if r.random() < 0.2 else "s", "c", r.choice([0.5, 0.5 + 1e-8, float("nan"), 1e13, 2e13, float("inf"), -2e-6, None]),
             None if r.random() < 0.02 else t, end, flag, r.choice(["I", "U", "d", "D", "R", None]), "x")
        )
    return out


def test_history(spark):
    data = rows(1, 700, 30)
    df = spark.createDataFrame(data, SCHEMA)
    want = brute(data)
    for parts in (1, 4, 60):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = sorted(tuple(r) for r in eh.person_history(df).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert got == want


def test_empty(spark):
    assert eh.person_history(spark.createDataFrame([], SCHEMA)).collect() == []


#: Values that a hash of the number would mix up: huge ones, NaN and infinities, values that drift by less than the tolerance.
RISKS = [0.25, 0.25 + 7e-7, 0.25 + 14e-7, 0.25 - 7e-7, 1e13, 2e13, -3e18, float("nan"), float("inf"), float("-inf"), -1e-6, -2e-6, -3e-6]
EVENT = st.tuples(st.integers(0, 40), st.sampled_from([eh.ROW, eh.ROW, eh.ROW, eh.DELETE]), st.integers(0, 2), st.one_of(st.none(), st.integers(1, 25)), st.sampled_from(RISKS))


@settings(max_examples=800, deadline=None)
@given(st.lists(st.lists(EVENT, max_size=14), min_size=1, max_size=3), st.booleans(), st.randoms(use_true_random=False))
def test_blocks_and_pieces_agree_with_the_walk(people, plain, rnd):
    e = {k: [] for k in ("p", "t", "kind", "sh", "risk", "origin")}
    want = []
    for p, events in enumerate(people):
        seen, mine = set(), []
        for t, kind, h, end, risk in events:
            if t in seen:
                continue
            seen.add(t)
            row = kind == eh.ROW
            mine.append((t, 1, kind, (h if plain else 1) if row else 0, (0.25 if plain else risk) if row else 0.0, 0))
            if row and end:
                mine.append((t + end, 0, eh.END, 0, 0.0, t))
        mine.sort(key=lambda x: x[:2])
        for t, _, kind, h, risk, o in mine:
            for k, v in zip(e, (p, t, kind, h, risk, o), strict=True):
                e[k].append(v)
        want += [(p, *v) for v in walk((t, k, h, r, o) for t, _, k, h, r, o in mine)]
    arrays = {k: np.array(v, float if k == "risk" else np.int64) for k, v in e.items()}
    got = eh.versions(arrays)
    assert sorted(zip(*(got[k].tolist() for k in ("p", "b", "e", "flag")), strict=True)) == sorted(want)
    # The same events cut into pieces anywhere.
    for p in set(e["p"]):
        mine = {k: v[arrays["p"] == p] for k, v in arrays.items()}
        n = len(mine["p"])
        cuts = sorted({0, n, *(rnd.randrange(n + 1) for _ in range(3))})
        done, left = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            final, events = eh.edge({k: v[a:b] for k, v in mine.items()})
            done += list(zip(*(final[k].tolist() for k in ("b", "e", "flag")), strict=True))
            left += list(zip(*(events[k].tolist() for k in ("p", "t", "kind", "sh", "risk", "origin")), strict=True))
        pieces = eh.pd.DataFrame(left, columns=["p", "a", "kind", "sh", "risk", "origin"])
        done += list(eh._stitch(pieces)[["b", "e", "flag"]].itertuples(index=False, name=None))
        assert sorted(done) == sorted(w[1:] for w in want if w[0] == p)


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 300)), max_size=60))
def test_bit_runs(pairs):
    pairs = sorted(set(pairs))
    g, a, b = eh.bit_runs(np.array([x[0] for x in pairs], np.int64), np.array([x[1] for x in pairs], np.int64))
    want = []
    for q, o in pairs:
        if want and want[-1][0] == q and want[-1][2] == o - 1:
            want[-1][2] = o
        else:
            want.append([q, o, o])
    assert list(zip(g.tolist(), a.tolist(), b.tolist(), strict=True)) == [tuple(w) for w in want]
