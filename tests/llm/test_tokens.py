import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
from hypothesis import given, settings, strategies as st  # noqa: E402

from strandline.llm import tokens as tk  # noqa: E402

PARTS = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "a", "É", "1", "½", "!", "。", "　", "\xa0", "中", "\r\n", "'S", "’", "​", "́", "<|endoftext|>", "👩‍💻"]


@pytest.fixture(scope="module")
def enc():
    return tk.encoder(tk.vocabulary_path())


def plain(enc, text):
    return enc.bpe.encode_ordinary(text or "")


@settings(max_examples=600, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), min_size=1, max_size=5))
def test_encoder_agrees(texts):
    enc = tk.encoder(tk.vocabulary_path())
    assert enc.encode([*texts, None]).to_pylist() == [plain(enc, t) for t in texts] + [[]]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(text):
    enc = tk.encoder(tk.vocabulary_path())
    ids = enc.encode([text]).to_pylist()[0]
    back = {v: k for k, v in tk.ranks(tk.vocabulary_path()).items()}
    assert b"".join(back[i] for i in ids).decode() == text


def test_forgetting_and_collisions(enc, monkeypatch):
    monkeypatch.setattr(tk, "_SLOTS", 4)
    monkeypatch.setattr(tk, "REMEMBER", 20)
    small = tk.Encoder(tk.vocabulary_path())
    texts = [" ".join(f"w{i * j}" for j in range(30)) for i in range(20)]
    for _ in range(3):
        assert small.encode(texts).to_pylist() == [plain(enc, t) for t in texts]
    assert small.overflow


def test_pretokens_with_one_hash_are_told_apart(enc):
    class Colliding(tk.Encoder):
        def __init__(self, path):
            super().__init__(path)
            # Every character counts the same wherever it stands, so anagrams share a hash.
            self.weights[:] = 3

    small = Colliding(tk.vocabulary_path())
    texts = ["stop spot tops", "post pots opts", "stop tops spot", "x" * 100 + " stop"]
    for _ in range(2):
        assert small.encode(texts).to_pylist() == [plain(enc, t) for t in texts]


def test_stitching_a_text_without_boundaries_costs_little(enc, monkeypatch):
    text = "y" * 40_000 + " the end of it"
    chunks = cut(enc, text, 1000, 50)
    lengths = []
    monkeypatch.setattr(tk, "encode_chunk", lambda e, t, real=tk.encode_chunk: (lengths.append(len(t)), real(e, t))[1])
    assert list(tk.stitch(enc, chunks)) == plain(enc, text)
    assert sum(lengths) < 4 * len(text)


def cut(enc, text, long, overlap):
    step = long - overlap
    n = (len(text) - overlap - 1) // step if len(text) > long else 0
    out = []
    for p in range(n + 1):
        ids, at, index = tk.encode_chunk(enc, text[p * step : p * step + long])
        near = (at < overlap) | (at >= step)
        near[-1:] = True
        out.append((p * step, text[p * step : p * step + long], ids, at[near], index[near]))
    return out


def test_stitching(enc):
    r = random.Random(3)
    for _ in range(1500):
        text = "".join(r.choice(PARTS) * r.choice([1, 1, 1, 5, 30]) for _ in range(r.randint(10, 50)))
        long, overlap = r.choice([12, 20, 40]), r.choice([2, 5, 10])
        if len(text) > long:
            assert list(tk.stitch(enc, cut(enc, text, long, overlap))) == plain(enc, text)


def test_documents(spark, enc, monkeypatch):
    long = " ".join(f"Row {i} of table n{i % 7}, it's late.\n" for i in range(4000))
    run = "x" * 90_000
    texts = [None, "", "  ", "a b", "a b", long, run, " " * 70_000 + "z", "<|endoftext|>"]
    rows = [(i if i != 4 else 3, t, "odd") for i, t in enumerate(texts)] + [(None, "null id", "odd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __text string")
    got = sorted(((r["doc_id"], tuple(r["ids"])) for r in tk.encode_documents(df, "text", ["doc_id"]).collect()), key=str)
    assert got == sorted(((i, tuple(plain(enc, t))) for i, t, _ in rows), key=str)
    assert tk.encode_documents(df.limit(0), "text", ["doc_id"]).count() == 0
