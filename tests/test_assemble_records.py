import random

import pytest
from hypothesis import given, settings, strategies as st

from strandline.operators import assemble_records as ar, reject_records as rr


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet='",a\r', max_size=14), st.sampled_from([",", ";"]))
def test_quotes_hold_as_the_reader_says(record, delimiter):
    try:
        rr.fields_of(rr.assemble(record), rr.Layout([("a", "string", True)], delimiter))
        want = True
    except rr.csv.Error:
        want = False
    assert ar.holds(record, delimiter) == want


def walk(line, delimiter, inside):
    """The state after a line, character by character."""
    at, begins = 0, not inside
    while at < len(line):
        c = line[at]
        if inside:
            if c == '"' and line[at + 1 : at + 2] == '"':
                at += 1
            elif c == '"':
                inside = False
        elif c == '"' and begins:
            inside = True
        begins = not inside and c == delimiter
        at += 1
    return int(inside)


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet='",a;', max_size=14), st.booleans())
def test_state_after_a_line(line, inside):
    assert ar.scan(line, ",", int(inside)) == walk(line, ",", inside)


def test_divide():
    assert ar.divide(["1,a", '2,"b', 'c"', "3,d"], ",") == [(0, "1,a"), (1, '2,"b\nc"'), (3, "3,d")]
    # The quote that is never closed costs its own line, not the good ones after it.
    assert ar.divide(['1,"open', "2,good", '3,"x"', "4,y"], ",") == [(0, '1,"open'), (1, "2,good"), (2, '3,"x"'), (3, "4,y")]
    assert ar.divide(['1,"open', "2,good"], ",") == [(0, '1,"open'), (1, "2,good")]
    assert ar.divide([""], ",") == [(0, "")] and ar.divide([], ",") == []


@pytest.mark.parametrize("size", ["64b", "1m"])
def test_records_across_lines_and_splits(spark, tmp_path, size):
    r = random.Random(3)
    want = []
    for f in range(3):
        lines = []
        for i in range(120):
            bad = r.random() < 0.03
            text = "\n".join("x" * r.randrange(40) + r.choice(["", ",", '""']) for _ in range(r.choice([1, 1, 2, 9])))
            record = f'{i},"{text}"' if r.random() < 0.6 else f"{i},plain"
            lines.append(record + ("\r" if f == 2 else ""))
            want.append(lines[-1])
            if bad:
                lines.append(f'{i},a"b"c')
                want.append(lines[-1])
        (tmp_path / f"f{f}.txt").write_bytes("\n".join(lines).encode() + (b"\n" if f else b""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "16b")
    try:
        for most in (ar.SPLITS, -1):
            old, ar.SPLITS = ar.SPLITS, most
            try:
                got = ar.assemble(spark, str(tmp_path), ",").collect()
            finally:
                ar.SPLITS = old
            assert sorted(x["record"] for x in got) == sorted(want)
            assert len({(x["file"], x["split"], x["first_line"]) for x in got}) == len(got)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_are_judged(spark, tmp_path):
    layout = spark.createDataFrame(
        [("T", 1, "id", "bigint", False, ";"), ("T", 2, "name", "string(9)", True, ";")], "table_name string, ordinal int, column_name string, value_type string, nullable boolean, delimiter string"
    )
    (tmp_path / "t.csv").write_text('1;"a;\nb"\n2;"open\n3;c\nx;d\n4\n5;\n')
    got = [(x["reason"], x["column_name"], x["fields"]) for x in ar.judge_files(spark, str(tmp_path / "t.csv"), layout, "T").orderBy("place").collect()]
    assert sorted(got, key=str) == sorted(
        [(None, "", ["1", "a;\nb"]), ("QUOTING", "", None), (None, "", ["3", "c"]), ("VALUE", "id", None), ("COLUMN_COUNT", "", None), (None, "", ["5", None])], key=str
    )
    (tmp_path / "none.csv").write_text("")
    assert ar.judge_files(spark, str(tmp_path / "none.csv"), layout, "T").count() == 0
    with pytest.raises(ValueError):
        ar.judge_files(spark, str(tmp_path / "t.csv"), layout, "U")
