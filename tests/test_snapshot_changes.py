import random
import unicodedata

from strandline.operators.snapshot_changes import account_changes

SCHEMA = (
    "sourcename string, acctnbr bigint, acctname string, acctstatcd string, mjaccttypcd string, branchnbr int, curbal double, intrate double, "
    "note string, _cdc_operation string, _cdc_is_current tinyint, _cdc_batch_id bigint, __n string"
)


def data(seed):
    r = random.Random(seed)
    state, out = {}, []
    for batch in (10, 20, 35, 50):
        for acct in range(25):
            if r.random() < 0.3:
                state[acct] = [r.choice(["Zoé", "Bo"]), r.choice([None, ""]), "T", r.choice([1, None]), r.choice([0.0, float("nan"), None, 2.5]), 0.1, "n"]
            if r.random() < 0.2:
                state.pop(acct, None)
        for acct, v in state.items():
            v = list(v)
            v[0] = r.choice([v[0], unicodedata.normalize("NFD", v[0]) + " "])
            v[4] = -0.0 if v[4] == 0.0 else v[4]
            v[5] += r.choice([0, 4e-7])
            for _ in range(40 if acct == 1 else r.choice([1, 1, 2])):
                out.append(("DNA" if acct % 2 else "CCM", None if r.random() < 0.02 and acct != 1 else acct, *v, "A", r.choice([1, 1, 1, 0, None]), batch, "x"))
    out.append(("DNA", 3, "q", "q", "q", 1, 1.0, 1.0, "q", "A", 1, None, "x"))
    out.append((None, 3, "q", "q", "q", 1, 1.0, 1.0, "q", "A", 1, 20, "x"))
    return out


def brute(rows):
    def canon(v):
        if isinstance(v, str):
            return unicodedata.normalize("NFC", v).rstrip(" ")
        return v

    snaps = {}
    for r in rows:
        if r[0] is None or r[1] is None or r[10] != 1 or r[11] is None:
            continue
        snaps.setdefault(r[11], {})[r[0], r[1]] = tuple(canon(v) for v in r[2:9])

    def eq(a, b):
        if a is None or b is None:
            return a is b
        if isinstance(a, float):
            return (a != a and b != b) or abs(a - b) < 1e-6
        return a == b

    out = set()
    ids = sorted(snaps)
    for p, n in zip(ids, ids[1:], strict=False):
        a, b = snaps[p], snaps[n]
        out |= {(n, *k, "I") for k in b.keys() - a.keys()} | {(n, *k, "D") for k in a.keys() - b.keys()}
        out |= {(n, *k, "U") for k in a.keys() & b.keys() if not all(map(eq, a[k], b[k]))}
    return out


def test_changes(spark):
    for seed in (1, 2):
        rows = data(seed)
        got = [tuple(r) for r in account_changes(spark.createDataFrame(rows, SCHEMA)).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_empty_and_single(spark):
    assert account_changes(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [r for r in data(1) if r[11] == 10]
    assert account_changes(spark.createDataFrame(rows, SCHEMA)).collect() == []
