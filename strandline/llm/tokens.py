"""Encoding of a whole corpus with a public byte-level BPE tokenizer.

The pre-tokens of a block of texts are found by array operations on its code points: a pre-token
starts where the class of character changes, with the pattern's rules for spaces and contractions.
Each distinct pre-token is merged once per worker and then found again by a 64-bit hash; what is found
is compared with the pre-token itself, so two that share a hash aren't mixed up.

Texts longer than ``LONG`` code points are cut into chunks that overlap by ``OVERLAP``.  The chunks
spread over the cluster, each is pre-tokenised and encoded by itself, and the pieces are stitched at
the first position in an overlap where both chunks have a pre-token boundary: the pattern looks only
ahead, so from there on both agree.  Where an overlap has no such position (one pre-token longer than
the overlap), chunks are joined and encoded again, each time as many more as were joined before, so a
text without boundaries costs a few times its length.

Defined results
- Null and empty texts give an empty list; a null id is kept.
- Strings of special tokens are ordinary text; no special token is added.
- Every row of the input gives one row, repeated ids included.  An empty table gives no rows.
- Lone surrogates can't occur in Spark strings.  Decoding is the concatenation of the tokens' bytes.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .codes import WHITE_SPACE, blocks, codes_of, members, SIZE

#: Code points beyond which a text is cut into chunks, and by which the chunks overlap.
LONG = 32_768
OVERLAP = 512
#: Distinct pre-tokens that a worker remembers before it starts afresh.
REMEMBER = 1_000_000
_SLOTS = 1 << 22
_DEEP = 64
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Place of a vocabulary file: ``folder``, else STRANDLINE_TOKENIZERS, else the installed package."""
    folder = folder or os.environ.get("STRANDLINE_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


#: The pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token ids by their bytes."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _classes() -> np.ndarray:
    table = np.zeros(SIZE, np.uint8)
    table[members(r"\p{L}")] = LETTER
    table[members(r"\p{N}")] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def pretoken_starts(u: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point; ``first`` has the indices where texts start."""
    n = len(u)
    if not n:
        return np.zeros(0, bool)
    c = _classes()[u]
    begin = np.zeros(n, bool)
    begin[first] = True
    start = begin.copy()
    start[1:] |= c[1:] != c[:-1]
    # The last space before something else belongs to it if it is U+0020, else it stands alone.
    meet = np.flatnonzero((c[1:] != SPACE) & (c[:-1] == SPACE) & ~begin[1:]) + 1
    start[meet - 1] = True
    start[meet[u[meet - 1] == 0x20]] = False
    quote = np.flatnonzero((u == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[(c[quote + 1] == LETTER) & ~begin[quote + 1]]
    if len(quote):
        a = u[quote + 1]
        at = np.minimum(quote + 2, n - 1)
        b = np.where((quote + 2 < n) & ~begin[at], u[at], 0)
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        one = np.isin(a, [ord(x) for x in "stmd"])
        start[quote[one | two] + 1] = False
        after = np.concatenate([quote[one] + 2, quote[two] + 3])
        after = after[after < n]
        # What follows a contraction starts anew, unless it is a letter's space, which has its own rule.
        start[after[c[after] == LETTER]] = True
    return start


class Encoder:
    """Pre-tokens to ids, with a memory of those met before."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})
        rng = np.random.default_rng(20240501)
        self.weights = rng.integers(0, 1 << 63, _DEEP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros((2, _SLOTS), np.uint64)
        self.slot = np.full((2, _SLOTS), -1, np.int32)
        self.overflow: dict[int, int] = {}
        self.tokens = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.offset = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int32)
        self.count = 0
        self.chars = np.zeros(1 << 16, np.uint32)
        self.spelt = 0
        self.place = np.zeros(1 << 14, np.int64)

    def _store(self, ids: list[int]) -> int:
        while self.used + len(ids) > len(self.tokens):
            self.tokens = np.concatenate([self.tokens, np.zeros_like(self.tokens)])
        if self.count == len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros_like(self.offset)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.tokens[self.used : self.used + len(ids)] = ids
        self.offset[self.count], self.length[self.count] = self.used, len(ids)
        self.used += len(ids)
        self.count += 1
        return self.count - 1

    def _merge(self, u: np.ndarray, a: int, b: int, keep: bool = False) -> int:
        """Number of a pre-token that is merged now; its characters are kept if it is to be found again."""
        number = self._store(self.bpe.encode_ordinary(u[a:b].tobytes().decode("utf-32-le", "surrogatepass")))
        if number >= len(self.place):
            self.place = np.concatenate([self.place, np.zeros_like(self.place)])
        if keep:
            while self.spelt + b - a > len(self.chars):
                self.chars = np.concatenate([self.chars, np.zeros_like(self.chars)])
            self.chars[self.spelt : self.spelt + b - a] = u[a:b]
            self.place[number] = self.spelt
            self.spelt += b - a
        return number

    def _unlike(self, u: np.ndarray, starts: np.ndarray, sizes: np.ndarray, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Pre-tokens that aren't spelt like the one they were found under; long ones aren't looked up."""
        short = sizes <= _DEEP
        expected = np.repeat(np.where(short, self.place[number], 0), sizes) + np.minimum(place, _DEEP - 1)
        return np.flatnonzero(np.logical_or.reduceat(self.chars[np.minimum(expected, len(self.chars) - 1)] != u, starts) & short)

    def pieces(self, u: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all pre-tokens and the number under which each is remembered."""
        if self.count > REMEMBER:
            self._clear()
        starts = np.flatnonzero(pretoken_starts(u, first))
        if not len(starts):
            return starts, np.zeros(0, np.int64)
        sizes = np.diff(starts, append=len(u))
        place = np.arange(len(u)) - np.repeat(starts, sizes)
        x = u.astype(np.uint64) + np.uint64(1)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= self.weights[np.minimum(place, _DEEP - 1)]
        key = np.add.reduceat(x, starts)
        key ^= key >> np.uint64(32)
        key = key * np.uint64(0xD6E8FEB86659FD93) + sizes.astype(np.uint64)
        key[key == 0] = 1
        number = np.full(len(starts), -1, np.int64)
        mask = np.uint64(_SLOTS - 1)
        long = sizes > _DEEP
        for t, at in enumerate(((key & mask).astype(np.int64), ((key >> np.uint64(40)) & mask).astype(np.int64))):
            hit = (self.keys[t][at] == key) & ~long
            number[hit] = self.slot[t][at[hit]]
        missing = np.flatnonzero((number < 0) & ~long)
        if len(missing):
            distinct, where, back = np.unique(key[missing], return_index=True, return_inverse=True)
            new = np.empty(len(distinct), np.int64)
            for i, (k, w) in enumerate(zip(distinct.tolist(), missing[where].tolist(), strict=True)):
                if k in self.overflow:
                    new[i] = self.overflow[k]
                    continue
                new[i] = self._merge(u, starts[w], starts[w] + sizes[w], keep=True)
                for t, s in enumerate((k & (_SLOTS - 1), (k >> 40) & (_SLOTS - 1))):
                    if self.slot[t][s] < 0:
                        self.keys[t][s], self.slot[t][s] = k, new[i]
                        break
                else:
                    self.overflow[k] = int(new[i])
            number[missing] = new[back]
        for i in np.flatnonzero(long).tolist():
            number[i] = self._merge(u, starts[i], starts[i] + sizes[i])
        for i in self._unlike(u, starts, sizes, number, place).tolist():
            number[i] = self._merge(u, starts[i], starts[i] + sizes[i])
        return starts, number

    def ids(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of remembered pre-tokens, one after another, and the number of tokens of each."""
        n = self.length[number].astype(np.int64)
        total = int(n.sum())
        before = np.cumsum(n) - n
        return self.tokens[np.arange(total) + np.repeat(self.offset[number] - before, n)], n

    def encode(self, texts: list[str | None]) -> pa.Array:
        """A list of ids for each text."""
        parts, offsets, done = [], [np.zeros(1, np.int64)], 0
        for a, b in blocks(texts):
            some = [t or "" for t in texts[a:b]]
            size = np.fromiter(map(len, some), np.int64, len(some))
            first = np.cumsum(size) - size
            u = codes_of("".join(some))
            starts, number = self.pieces(u, first[size > 0])
            ids, n = self.ids(number)
            ends = np.concatenate([[0], np.cumsum(n)])
            offsets.append(done + ends[np.searchsorted(starts, first + size)])
            done += len(ids)
            parts.append(ids)
        values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(values, pa.int32()))


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder."""
    return Encoder(path)


def encode_chunk(enc: Encoder, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a chunk, the starts of its pre-tokens, and the index of each one's first id."""
    u = codes_of(text)
    starts, number = enc.pieces(u, np.zeros(1 if len(u) else 0, np.int64))
    ids, n = enc.ids(number)
    return ids, starts, np.cumsum(n) - n


def stitch(enc: Encoder, chunks: list[tuple[int, str, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Ids of a text from its chunks: (start in the text, chunk, ids, starts of pre-tokens, first ids).

    Starts may be just those inside the overlaps; all are relative to the chunk.
    """
    out = []
    at, text, ids, starts, index = chunks[0]
    low, joined, i = 0, 1, 1
    while i < len(chunks):
        nxt = chunks[i]
        # A chunk's last pre-token may be cut short, so the ones from there on don't count.
        mine = starts[:-1] - (nxt[0] - at)
        common, here, there = np.intersect1d(mine, nxt[3], return_indices=True)
        keep = np.flatnonzero((common >= 0) & (index[here] >= low))
        if not len(keep):
            more = chunks[i : i + joined]
            text = text[: nxt[0] - at] + "".join(c[1][: d[0] - c[0]] for c, d in zip(more, more[1:], strict=False)) + more[-1][1]
            ids, starts, index = encode_chunk(enc, text)
            if out:
                low = int(index[np.searchsorted(starts, base)])
            i += len(more)
            joined += len(more)
            continue
        k = keep[0]
        out.append(ids[low : index[here[k]]])
        low = int(nxt[4][there[k]])
        base = int(common[k])
        at, text, ids, starts, index = nxt
        i, joined = i + 1, 1
    out.append(ids[low:])
    return np.concatenate(out)


def encode_documents(docs: DataFrame, text: str, keep: list[str], vocabulary: str | None = None) -> DataFrame:
    """``keep`` and the column ``ids`` of every row of ``docs``.

    ``vocabulary`` is a path that every executor can read; by default each finds its own.
    """
    size = F.length(F.col(text))
    plain = docs.where(size.isNull() | (size <= LONG)).select(*keep, F.col(text).alias("__text"))
    kinds = T.StructType([*[plain.schema[c] for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary or vocabulary_path())
        for batch in it:
            ids = enc.encode(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], ids], [*keep, "ids"])

    # A long text's chunks meet again by the place of its row, not by an id, which may repeat.
    long = docs.where(size > LONG).select(*keep, F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__row"))
    step = LONG - OVERLAP
    starts = F.sequence(F.lit(0), F.floor((F.length("__text") - OVERLAP - 1) / step).cast("int"))
    cut = long.select(*keep, "__row", "__text", F.explode(starts).alias("__part")).select(
        *keep, "__row", "__part", F.substring(F.col("__text"), F.col("__part") * step + 1, F.lit(LONG)).alias("__text")
    )
    chunks = cut.repartition("__row", "__part")
    chunk_schema = T.StructType(
        [*[chunks.schema[c] for c in [*keep, "__row", "__part", "__text"]], *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("__ids", "__starts", "__index")]]
    )

    def run_chunks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary or vocabulary_path())
        names = [*keep, "__row", "__part", "__text"]
        for batch in it:
            found = []
            for t in batch.column("__text").to_pylist():
                ids, at, index = encode_chunk(enc, t)
                near = (at < OVERLAP) | (at >= step)
                near[-1:] = True
                found.append((ids, at[near], index[near]))
            columns = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *columns], [*names, "__ids", "__starts", "__index"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(vocabulary or vocabulary_path())
        pdf = pdf.sort_values("__part")
        ids = stitch(
            enc,
            [
                (int(p) * step, t, np.asarray(i), np.asarray(s), np.asarray(x))
                for p, t, i, s, x in zip(pdf["__part"], pdf["__text"], pdf["__ids"], pdf["__starts"], pdf["__index"], strict=True)
            ],
        )
        out = pdf.iloc[:1][keep].copy()
        out["ids"] = [ids]
        return out

    stitched = chunks.mapInArrow(run_chunks, chunk_schema).groupBy("__row").applyInPandas(join, kinds)
    return plain.mapInArrow(run, kinds).unionByName(stitched)
