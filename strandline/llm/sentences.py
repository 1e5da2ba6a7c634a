"""Sentence boundaries across languages and scripts.

A linear-chain model tags every character as boundary or inside, and Viterbi decoding picks the best
tags of each stretch of text.  Only a character that could end a sentence (a mark, a closing bracket
after one, a space between Thai or Lao letters) has a score of its own; the score of all others is that of
staying inside, so the chain is decoded over the candidates alone with the same result.  The stretches
of a whole block of documents are decoded together, step by step, by array operations.

The weights are learned by conditional likelihood (a linear-chain conditional random field) from
paragraphs that are put together from the sentences in :mod:`sentence_lexicon`, so their boundaries
are known; for scripts without sentence marks the punctuation is stripped first and the boundaries
fall on spaces.  Training takes a few seconds, has a fixed seed, and doesn't see the corpus: the model
is the same at every size.

Marks of scripts that have their own are candidates as well, and so are words that can only be
abbreviations (no vowel), whether the lists know them or not.  Runs of marks, brackets and digits count
in full, and words are compared whole, whatever their length.

Line structure comes first and fixes some tags: blank lines, headings, log lines, list items and the
line that introduces a list.  Marks inside a matched quotation or bracket are inside.

Defined results
- Null, empty and blank texts, and lines without letter or digit, have no sentences.
- Repeated ids are told apart by nothing: each row gives its own sentences.
- Offsets count code points; LF, CR and CRLF end lines.  Texts may be of any length; blocks of about a
  million code points are worked on at a time, and longer texts are cut at blank lines, which end
  sentences anyway.  An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import sentence_lexicon as lex
from .codes import BLOCK, SIZE, WHITE_SPACE, blocks, codes_of, members

#: Full stops and question marks of scripts that have their own, beside those of Latin and East Asian text.
_OWN_STOPS = "।॥۔؟።፧፨។៕။།༎։෴᠃᠉᭞᭟꧈꧉꯫꫰꫱߹⸮᪨᪩᱾᱿꤯꘎꘏꛳꛷𑁇𑁈"
_TERMINALS = ".!?…。！？‼⁇⁈⁉｡．" + _OWN_STOPS
_CJK_TERMINALS = "。！？｡．"
_ALWAYS = "。！？｡!?‼⁇⁈⁉" + _OWN_STOPS
_PAIRS = {"(": ")", "[": "]", "（": "）", "［": "］", "【": "】", "「": "」", "『": "』", "《": "》", "«": "»", "“": "”", "„": "“", "‹": "›"}
_OPENERS = "".join(_PAIRS)
_QUOTES = "\"«“„「『‹"
_CLOSERS = ")]）］】」』》»”›\"“’'"
_BULLETS = "-*•–—·‣▪◦●"
_HEADS = "■□◆◇▶●※#"
# Kinds of candidate, classes of the word before a mark, of what comes next.
DOT, DOTS, ASK, WIDE, GREEK, CLOSE, THAI = range(7)
PLAIN, INNER, EITHER, INITIAL, NUMBER, MUTE, DATE = range(7)
UPPER, LOWER, DIGIT, CASELESS, OPENER, DASH, SYMBOL, END = range(8)


@cache
def _tables() -> dict[str, np.ndarray]:
    t = {
        "upper": members(r"[\p{Lu}\p{Lt}]"),
        "lower": members(r"\p{Ll}"),
        "letter": members(r"[\p{L}\p{M}]"),
        "digit": members(r"\p{N}"),
        "greek": members(r"\p{Greek}") & members(r"\p{L}"),
        "cjk": members(r"[\p{Han}\p{Hiragana}\p{Katakana}ー々〆]"),
        "kana": members(r"\p{Hiragana}"),
        # Scripts without sentence marks, in which spaces part sentences and phrases, and all that put no space between words.
        "thai": members(r"[ก-ฺเ-๎]"),
        "lao": members(r"[ກ-ຽເ-ໆ່-ໍໜ-ໟ]"),
        "packed": members(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]"),
        "vowel": members(r"[aeiouyàâäáãåæèéêëìíîïòóôöõøœùúûüýÿаеёиоуыэюяєіїαεηιουωάέήίόύώϊϋΐΰ]"),
        "spelt": members(r"[\p{Latin}\p{Cyrillic}\p{Greek}]") & members(r"\p{L}"),
    }
    # Both parts of a line with a letter or a digit; marks alone don't count.
    t["alnum"] = members(r"\p{L}") | t["digit"]
    white = np.zeros(SIZE, bool)
    white[WHITE_SPACE] = True
    t["white"] = white
    blank = white.copy()
    blank[0xFEFF] = True
    t["blank"] = blank
    for name, chars in (
        ("term", _TERMINALS), ("wide", _CJK_TERMINALS), ("always", _ALWAYS), ("open", _OPENERS + "¿¡\""), ("close", _CLOSERS), ("bullet", _BULLETS),
        ("head", _HEADS), ("dash", "-–—―"), ("bracket", "".join(set(_OPENERS + "".join(_PAIRS.values()) + '"'))),
    ):
        x = np.zeros(SIZE, bool)
        x[[ord(c) for c in chars]] = True
        t[name] = x
    low = np.arange(SIZE, dtype=np.uint32)
    for i in np.flatnonzero(t["upper"]).tolist():
        c = chr(i).lower()
        if len(c) == 1:
            low[i] = ord(c)
    t["low"] = low
    return t


def _hash(rows: np.ndarray) -> np.ndarray:
    weights = np.random.default_rng(20240607).integers(1, 1 << 63, rows.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    x = (rows.astype(np.uint64) + np.uint64(7)) * weights
    return (x ^ (x >> np.uint64(31))).sum(axis=1, dtype=np.uint64)


@cache
def _lexicon() -> dict[str, np.ndarray]:
    """Hashes of the words of each list; ``width`` is one more than the longest word, so no longer word is taken for one of them."""
    lists = {"inner": (lex.INNER, True), "either": (lex.EITHER, True), "titles": (lex.TITLES, True), "joined": (lex.JOINED, False), "dates": (lex.DATES, True)}
    spelt = {k: sorted({unicodedata.normalize(form, w) for w in words for form in ("NFC", "NFD")}) for k, (words, _) in lists.items()}
    width = 1 + max(len(w) for words in spelt.values() for w in words)
    out = {"width": np.array(width)}
    for name, (_, backwards) in lists.items():
        rows = np.zeros((len(spelt[name]), width), np.uint32)
        for i, w in enumerate(spelt[name]):
            rows[i, : len(w)] = [ord(x) for x in (w[::-1] if backwards else w)]
        out[name] = np.sort(_hash(rows))
    return out


def _among(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys


def _before(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    """The word that ends just before each index: its last characters, backwards, in lower case."""
    t = _tables()
    at = i[:, None] - 1 - np.arange(int(_lexicon()["width"]))
    c = u[np.maximum(at, 0)]
    stop = (at < 0) | t["blank"][c] | t["open"][c] | (c == 0x2019) | (c == 0x27)
    c = np.where(np.logical_or.accumulate(stop, axis=1), 0, t["low"][c])
    return c


def _after(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    """The letters that begin at each index, in lower case."""
    t = _tables()
    at = i[:, None] + np.arange(int(_lexicon()["width"]))
    c = u[np.minimum(at, len(u) - 1)]
    stop = (at >= len(u)) | ~t["letter"][c]
    return np.where(np.logical_or.accumulate(stop, axis=1), 0, t["low"][c])


def _run_end(on: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the run of true values that each index lies in ends; the index itself where it is in none."""
    i = np.flatnonzero(on)
    if not len(i):
        return at
    ends = i[np.append(i[1:] != i[:-1] + 1, True)] + 1
    inside = at < len(on)
    inside[inside] = on[at[inside]]
    return np.where(inside, ends[np.minimum(np.searchsorted(ends, at, side="right"), len(ends) - 1)], at)


def _run_begin(on: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the run of true values that each index lies in begins; the index itself where it is in none."""
    i = np.flatnonzero(on)
    if not len(i):
        return at
    begins = i[np.append(True, i[1:] != i[:-1] + 1)]
    return np.where(on[at], begins[np.maximum(np.searchsorted(begins, at, side="right") - 1, 0)], at)


def _pairs(u: np.ndarray, zone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outermost matched brackets and quotations, inside one zone each: (open, close)."""
    at = np.flatnonzero(_tables()["bracket"][u])
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    done: list[tuple[int, int]] = []
    here = -1

    def flush() -> None:
        end = -1
        for a, b in sorted(done):
            if a > end:
                out.append((a, b))
                end = b
        done.clear()
        stack.clear()

    for i, c, z in zip(at.tolist(), map(chr, u[at].tolist()), zone[at].tolist(), strict=True):
        if z != here:
            flush()
            here = z
        if c == '"':
            match = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
        elif c == "“":
            match = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "“" and chr(int(u[stack[k][1]])) == "„"), None)
        elif c in _PAIRS:
            match = None
        else:
            match = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == c), None)
            if match is None:
                continue
        if match is None:
            stack.append((_PAIRS.get(c, c), i))
        else:
            done.append((stack[match][1], i))
            del stack[match:]
    flush()
    a = np.array([x[0] for x in out], np.int64)
    return a, np.array([x[1] for x in out], np.int64)


def _digits(u: np.ndarray, at: np.ndarray, pattern: str) -> np.ndarray:
    """Whether the text at each index has the pattern: 0 a digit, other characters themselves."""
    ok = at + len(pattern) <= len(u)
    for k, c in enumerate(pattern):
        x = u[np.minimum(at + k, len(u) - 1)]
        ok &= (x >= 48) & (x <= 57) if c == "0" else ((x == 32) | (x == ord("T"))) if c == "T" else (x == ord(c))
    return ok


def candidates(u: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Line structure and candidates of texts laid end to end; ``first`` has where each begins.

    ``hard``: indices at which a new stretch begins.  ``at``: where the text after a candidate begins,
    with the candidate's feature numbers in ``features`` and the stretch it lies in.
    """
    t = _tables()
    n = len(u)
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    lf, cr = u == 10, u == 13
    ends_line = lf.copy()
    ends_line[:-1] |= cr[:-1] & ~lf[1:]
    ends_line[-1] |= cr[-1]
    line = begins[:n].copy()
    line[1:] |= ends_line[:-1]
    s = np.flatnonzero(line)
    e = np.append(s[1:], n)
    blank = t["blank"][u]
    full = np.flatnonzero(~blank)
    lo = np.searchsorted(full, s)
    hi = np.searchsorted(full, e)
    has = hi > lo
    f0 = full[np.minimum(lo, len(full) - 1)] if len(full) else np.zeros(len(s), np.int64)
    l0 = full[np.maximum(hi - 1, 0)] if len(full) else np.zeros(len(s), np.int64)
    words = np.flatnonzero(t["alnum"][u])
    spoken = np.searchsorted(words, e) > np.searchsorted(words, s)
    c0, c1 = u[f0], u[np.minimum(f0 + 1, n - 1)]
    text_start = begins[s]
    prior = np.roll(np.arange(len(s)), 1)
    log_at = f0 + ((c0 == ord("[")) | (c0 == ord("(")))
    log = has & spoken & (_digits(u, log_at, "0000-00-00T00:00"))
    space1 = t["white"][c1] & (f0 + 1 < l0)
    bullet = t["bullet"][c0] & space1
    marker_end = f0 + 1
    # A number of any length with a point or bracket after it.
    past = _run_end((u >= 48) & (u <= 57), f0)
    x, y = u[np.minimum(past, n - 1)], u[np.minimum(past + 1, n - 1)]
    number = (past > f0) & (past < n) & ((x == ord(".")) | (x == ord(")"))) & t["white"][y] & (past + 1 < l0)
    marker_end = np.where(number, past, marker_end)
    number |= t["letter"][c0] & (c1 == ord(")")) & t["white"][u[np.minimum(f0 + 2, n - 1)]]
    head = has & spoken & ~log & t["head"][c0]
    hashes = c0 == ord("#")
    if hashes.any():
        k = np.ones(len(s), np.int64)
        for j in range(1, 7):
            k += (k == j) & (u[np.minimum(f0 + j, n - 1)] == ord("#"))
        head &= ~hashes | t["white"][u[np.minimum(f0 + k, n - 1)]]
    colon = has & ((u[l0] == ord(":")) | (u[l0] == ord("："))) & spoken
    marked = has & spoken & (bullet | number) & ~log & ~head
    apart = text_start | ~has[prior] | ~spoken[prior] | log[prior] | head[prior]
    # A wrapped line can begin with a dash or an ordinal: items begin a paragraph or follow a colon.
    group = marked & ~(marked[prior] & ~text_start)
    sound = group & (apart | (colon[prior] & ~text_start))
    number_of = np.cumsum(group)
    item = marked & np.append(False, sound[np.flatnonzero(group)])[np.where(marked, number_of, 0)]
    following = np.append(item[1:] & ~text_start[1:], False)
    intro = colon & following & ~item & ~log
    # A numbered line alone in its paragraph is a heading as much as an item: it is one sentence either way.
    alone = log | head | intro
    hard = text_start | ~has | ~spoken | item | alone | apart
    hard |= np.append(False, (alone[:-1] | ~spoken[:-1]))
    zone = np.cumsum(hard)
    starts = s[hard]
    per_char = np.repeat(zone, e - s) - 1
    whole = np.zeros(len(starts), bool)
    whole[zone[alone | ~spoken] - 1] = True
    marker_zone = zone[item] - 1
    skip = np.full(len(starts), -1, np.int64)
    skip[marker_zone] = marker_end[item]

    opened, closed = _pairs(u, per_char)
    # Marks: the last of a run, followed by what may belong to it.
    term = t["term"][u]
    mark = term | (u == ord(";")) | (u == 0x37E)
    last = mark.copy()
    last[:-1] &= ~(mark[1:] & ~begins[1:n])
    i = np.flatnonzero(last)
    if len(opened):
        j = np.searchsorted(opened, i) - 1
        inside = (j >= 0) & (i < closed[np.maximum(j, 0)])
        i = i[~inside]
    i = i[~whole[per_char[i]]]
    # Marks inside an item's marker don't count.
    i = i[i > skip[per_char[i]]] if len(i) else i
    # Closing marks right after belong to the sentence, unless they open something.
    nxt = i + 1
    pair_open = np.zeros(n + 1, bool)
    pair_open[opened] = True
    closing = t["close"][u] & ~pair_open[:n]
    closing[1:] &= (per_char[1:] == per_char[:-1])
    nxt = _run_end(closing, nxt)
    c = u[i]
    kind = np.full(len(i), DOT)
    # The first of the marks that stand together; what precedes it is the word before.
    follows = term & ~begins[:n]
    follows[1:] &= term[:-1]
    follows[:1] = False
    before_run = _run_begin(follows, i) - follows[i]
    kind[(c == ord("…")) | ((c == ord(".")) & (before_run < i))] = DOTS
    kind[t["always"][c]] = ASK
    kind[t["wide"][c]] = WIDE
    first_mark = u[before_run]
    kind[(kind == DOTS) & (t["always"][first_mark])] = ASK
    greek = (c == ord(";")) | (c == 0x37E)
    kind[greek] = GREEK
    p = u[np.maximum(i - 1, 0)]
    ok = ~greek | t["greek"][p]
    x = u[np.minimum(nxt, n - 1)]
    spaced = (nxt >= n) | t["blank"][x] | begins[np.minimum(nxt, n)]
    # A narrow mark without space after it ends nothing, unless a script without spaces goes on.
    ok &= spaced | (kind == WIDE) | ((kind == ASK) & t["packed"][x] & t["packed"][p])
    i, nxt, kind, before_run, spaced = i[ok], nxt[ok], kind[ok], before_run[ok], spaced[ok]

    # Ends of quotations and brackets whose last word is a sentence's end.
    extra = np.zeros(0, np.int64)
    at_start = colon_before = is_quote = np.zeros(0, bool)
    after_close = extra
    if len(closed):
        prev_full = full[np.maximum(np.searchsorted(full, closed) - 1, 0)]
        ending = t["term"][u[prev_full]] & (prev_full > opened) & ~whole[per_char[closed]]
        extra, o = closed[ending], opened[ending]
        after_close = extra + 1
        x = u[np.minimum(after_close, n - 1)]
        gap = (after_close >= n) | t["blank"][x] | begins[np.minimum(after_close, n)]
        wide = t["wide"][u[prev_full[ending]]]
        keep = gap | wide
        extra, o, after_close = extra[keep], o[keep], after_close[keep]
        k = np.searchsorted(full, o) - 1
        q = full[np.maximum(k, 0)]
        cq = u[q]
        at_start = (k < 0) | (q < starts[per_char[o]]) | t["term"][cq] | (t["close"][cq] & t["term"][u[np.maximum(q - 1, 0)]])
        colon_before = ~at_start & ((cq == ord(":")) | (cq == ord("：")) | (cq == ord(",")) | (cq == ord("，")))
        is_quote = np.isin(u[o], [ord(x) for x in _QUOTES])

    # Spaces between letters of a script without sentence marks.
    gaps = np.zeros(0, np.int64)
    for script in ("thai", "lao"):
        th = t[script][u]
        if th.any():
            b = np.flatnonzero(th[:-1] & blank[1:])
            k = np.searchsorted(full, b + 1)
            ok = k < len(full)
            b, to = b[ok], full[np.minimum(k, len(full) - 1)][ok]
            ok = th[to] & (per_char[b] == per_char[to]) & ~whole[per_char[b]]
            gaps = np.concatenate([gaps, b[ok]])
    if len(gaps):
        if len(opened) and len(gaps):
            j = np.searchsorted(opened, gaps) - 1
            gaps = gaps[~((j >= 0) & (gaps < closed[np.maximum(j, 0)]))]

    # Features.
    m, mc, mt = len(i), len(extra), len(gaps)
    at = np.concatenate([nxt, after_close, gaps + 1])
    pos = np.concatenate([i, extra, gaps])
    kinds = np.concatenate([kind, np.full(mc, CLOSE), np.full(mt, THAI)])
    z = per_char[pos]
    k = np.searchsorted(full, at)
    goes_on = k < len(full)
    to = full[np.minimum(k, len(full) - 1)] if len(full) else np.zeros(len(at), np.int64)
    goes_on &= per_char[to] == z
    x = u[to]
    y = u[np.minimum(to + 1, n - 1)]
    nx = np.full(len(at), SYMBOL)
    nx[t["letter"][x]] = CASELESS
    nx[t["upper"][x]] = UPPER
    nx[t["lower"][x]] = LOWER
    nx[t["digit"][x]] = DIGIT
    nx[t["open"][x]] = OPENER
    nx[t["dash"][x] & t["white"][y]] = DASH
    nx[~goes_on] = END
    word = np.full(len(at), PLAIN)
    if m:
        w = _before(u, before_run)
        h = _hash(w)
        table = _lexicon()
        word[:m][_among(h, table["either"])] = EITHER
        word[:m][_among(h, table["dates"])] = DATE
        word[:m][_among(h, table["inner"])] = INNER
        long = (w != 0).sum(axis=1)
        capital = t["upper"][u[np.maximum(before_run - np.maximum(long, 1), 0)]]
        word[:m][_among(h, table["titles"]) & capital] = INNER
        # One letter by itself, not the rest of a word after an apostrophe ("isn't.").
        apart = u[np.maximum(before_run - 2, 0)]
        single = t["letter"][w[:, 0]] & (w[:, 1] == 0) & ~t["cjk"][w[:, 0]] & (apart != 0x27) & (apart != 0x2019)
        word[:m][single & ((word[:m] == PLAIN) | (capital & (word[:m] == EITHER)))] = INITIAL
        word[:m][t["digit"][w[:, 0]] & (word[:m] == PLAIN)] = NUMBER
        # Words that nobody could speak are abbreviations, known or not: short, spelt in letters, no vowel, not all capitals.
        raw = u[np.maximum(before_run[:, None] - 1 - np.arange(w.shape[1]), 0)]
        letters = (w == 0) | t["spelt"][w]
        shouted = ((w == 0) | t["upper"][raw]).all(axis=1)
        mute = (long > 1) & (long < 6) & letters.all(axis=1) & ~(t["vowel"][w] & (w != 0)).any(axis=1) & ~shouted
        # A unit after its number ("5 km.") can end a sentence like any word.
        unit = np.maximum(before_run - long - 2, 0)
        mute &= ~(t["digit"][u[unit]] & blank[np.minimum(unit + 1, n - 1)])
        word[:m][mute & (word[:m] == PLAIN)] = MUTE
        word[:m][kind != DOT] = PLAIN
    joined = _among(_hash(_after(u, to)), _lexicon()["joined"]) & goes_on
    # Whether the next word is an identifier: it has an underscore, a digit or a capital inside.
    score = u == ord("_")
    part = score.copy()
    part[words] = True
    gap = np.append(np.flatnonzero(~part), n)
    capitals = np.flatnonzero(t["upper"][u])
    capitals = capitals[t["lower"][u[np.maximum(capitals - 1, 0)]]]
    odd = np.sort(np.concatenate([np.flatnonzero(score | t["digit"][u]), capitals]))
    under = x == ord("_")
    end = gap[np.searchsorted(gap, to)]
    named = (np.searchsorted(odd, end) > np.searchsorted(odd, to + ~under)) & (t["letter"][x] | under) & goes_on
    close = np.zeros(len(at), np.int64)
    close[m : m + mc] = 1 + is_quote + 2 * at_start + 4 * colon_before
    kana = t["kana"][x] & goes_on
    columns = [kinds, kinds * 8 + nx, word * 8 + nx, close * 8 + nx, joined, named, np.where(kinds == CLOSE, 1 + kana, 0), np.where(kinds == DOT, 1 + word, 0), np.where(named, 1 + word, 0)]
    features = np.stack([c + first for c, first in zip(columns, _FIRST, strict=True)], axis=1)
    order = np.lexsort((at, z))
    return {"hard": starts, "whole": whole, "at": at[order], "zone": z[order], "features": features[order], "full": full, "blank": blank, "words": words}


#: How many values each group of features has, and where each group begins.
_GROUPS = (7, 56, 56, 72, 2, 2, 3, 8, 8)
_FIRST = [sum(_GROUPS[:i]) for i in range(len(_GROUPS))]
FEATURES = sum(_GROUPS)


def viterbi(zone: np.ndarray, score: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags (1 boundary) of many chains at once.

    ``score`` is what boundary gains over inside at each candidate, ``step`` the 2 x 2 gains of a tag
    after a tag; candidates of one zone are adjacent and form a chain, which starts after a boundary.
    """
    if not len(zone):
        return np.zeros(0, np.int8)
    begin, live = _chains(zone)
    back = np.zeros((len(zone), 2), np.int8)
    best = np.stack([np.full(len(begin), -1e18), np.zeros(len(begin))], axis=1)
    for k, a in enumerate(live):
        at = begin[:a] + k
        stay, leave = best[:a, 0], best[:a, 1]
        for tag in (0, 1):
            x, y = stay + step[0, tag], leave + step[1, tag]
            back[at, tag] = y > x
            gain = np.maximum(x, y) + (score[at] if tag else 0.0)
            if tag:
                best[:a, 0], best[:a, 1] = kept, gain
            else:
                kept = gain
    tags = np.zeros(len(zone), np.int8)
    now = (best[:, 1] > best[:, 0]).astype(np.int8)
    for k in range(len(live) - 1, -1, -1):
        a = live[k]
        at = begin[:a] + k
        tags[at] = now[:a]
        now[:a] = back[at, now[:a]]
    return tags


def _training_texts(seed: int, size: int) -> tuple[list[str], list[list[int]]]:
    """Paragraphs of whole sentences and the offset where each sentence after the first begins."""
    rng = np.random.default_rng(seed)
    texts, marks = [], []
    groups = [(k, v, "" if k in ("ja", "zh") else " ") for k, v in lex.SENTENCES.items()]
    groups += [(k, tuple(s.rstrip(".!?") for s in v), " ") for k, v in lex.UNMARKED.items()]
    weights = np.array([len(g[1]) for g in groups], float)
    weights /= weights.sum()
    for _ in range(size):
        _, pool, gap = groups[rng.choice(len(groups), p=weights)]
        text, found = "", []
        for j in range(int(rng.integers(2, 7))):
            s = pool[rng.integers(len(pool))]
            if text:
                text += "\n" if gap and rng.random() < 0.2 else gap
                found.append(len(text))
            text += s
        texts.append(text)
        marks.append(found)
    return texts, marks


def _lay(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end with a line end after each, and where each begins."""
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return codes_of("\n".join([*texts, ""])), np.cumsum(size) - size


def _chains(zone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First candidates of the chains, longest chain first, and how many chains reach each step."""
    new = np.ones(len(zone), bool)
    new[1:] = zone[1:] != zone[:-1]
    begin = np.flatnonzero(new)
    size = np.diff(begin, append=len(zone))
    order = np.argsort(-size, kind="stable")
    return begin[order], np.searchsorted(-size[order], -np.arange(1, int(size.max()) + 1), side="right")


def expectations(zone: np.ndarray, score: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a boundary at each candidate, and expected numbers of each step."""
    begin, live = _chains(zone)
    emit = np.stack([np.zeros(len(zone)), score], axis=1)
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    for k, a in enumerate(live):
        at = begin[:a] + k
        if k:
            forward[at] = emit[at] + np.logaddexp(forward[at - 1, :1] + step[0], forward[at - 1, 1:] + step[1])
        else:
            forward[at] = emit[at] + step[1]
    for k in range(len(live) - 2, -1, -1):
        at = begin[: live[k + 1]] + k
        nxt = emit[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(step[:, 0] + nxt[:, :1], step[:, 1] + nxt[:, 1:])
    both = forward + backward
    norm = np.logaddexp(both[:, 0], both[:, 1])
    chance = np.exp(both[:, 1] - norm)
    steps = np.zeros((2, 2))
    starts = np.zeros(len(zone), bool)
    starts[begin] = True
    steps[1, 1] += chance[begin].sum()
    steps[1, 0] += (1 - chance[begin]).sum()
    at = np.flatnonzero(~starts)
    for x in (0, 1):
        for y in (0, 1):
            steps[x, y] += np.exp(forward[at - 1, x] + step[x, y] + emit[at, y] + backward[at, y] - norm[at]).sum()
    return chance, steps


@cache
def model(seed: int = 7, paragraphs: int = 5000, rounds: int = 120, rate: float = 0.25, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of the steps between tags, by conditional likelihood."""
    texts, marks = _training_texts(seed, paragraphs)
    u, first = _lay(texts)
    c = candidates(u, first)
    gold_at = np.concatenate([first[i] + np.asarray(m, np.int64) for i, m in enumerate(marks)])
    to = np.append(c["full"], len(u))[np.searchsorted(c["full"], c["at"])]
    # A stretch's last candidate ends where the stretch does, so it counts as a boundary.
    gold = (np.isin(to, gold_at) | (to >= np.append(c["hard"], len(u))[c["zone"] + 1])).astype(np.int64)
    new = np.ones(len(gold), bool)
    new[1:] = c["zone"][1:] != c["zone"][:-1]
    before = np.where(new, 1, np.roll(gold, 1))
    flat = c["features"].ravel()
    wide = c["features"].shape[1]
    want = np.bincount(flat, np.repeat(gold, wide), FEATURES)
    want_step = np.bincount(before * 2 + gold, minlength=4).reshape(2, 2)
    x, first_moment, second_moment = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    for r in range(1, rounds + 1):
        chance, steps = expectations(c["zone"], x[c["features"]].sum(axis=1), x[FEATURES:].reshape(2, 2))
        got = np.bincount(flat, np.repeat(chance, wide), FEATURES)
        g = np.concatenate([want - got, (want_step - steps).ravel()]) / len(gold) - decay * x
        first_moment = 0.9 * first_moment + 0.1 * g
        second_moment = 0.99 * second_moment + 0.01 * g * g
        x = x + rate * (first_moment / (1 - 0.9**r)) / (np.sqrt(second_moment / (1 - 0.99**r)) + 1e-8)
    return x[:FEATURES], x[FEATURES:].reshape(2, 2)


def spans(texts: list[str], weights: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentences of a block of texts: (number of the text, start, end), in order."""
    u, first = _lay(texts)
    if not len(u):
        none = np.zeros(0, np.int64)
        return none, none, none
    c = candidates(u, first)
    tags = viterbi(c["zone"], weights[0][c["features"]].sum(axis=1), weights[1])
    cut = np.unique(np.concatenate([c["hard"], c["at"][tags == 1]]))
    end = np.append(cut[1:], len(u))
    full = c["full"]
    lo, hi = np.searchsorted(full, cut), np.searchsorted(full, end)
    spoken = np.searchsorted(c["words"], end) > np.searchsorted(c["words"], cut)
    ok = (hi > lo) & spoken
    a, b = full[lo[ok]], full[hi[ok] - 1] + 1
    of = np.searchsorted(first, a, side="right") - 1
    return of, a - first[of], b - first[of]


def pieces(text: str) -> Iterator[tuple[int, str]]:
    """A text, or, if it is longer than a block, its parts between blank lines."""
    at = 0
    while len(text) - at > 2 * BLOCK:
        stop = text.find("\n\n", at + BLOCK)
        if stop < 0:
            break
        yield at, text[at : stop + 2]
        at = stop + 2
    yield at, text[at:]


def split_documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, start_char, end_char): one row per sentence of every text."""
    weights = model()
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            owner, offset, texts = [], [], []
            for i, whole in enumerate(batch.column("__text").to_pylist()):
                for at, part in pieces(whole):
                    owner.append(i)
                    offset.append(at)
                    texts.append(part)
            own, off = np.asarray(owner, np.int64), np.asarray(offset, np.int64)
            for a, b in blocks(texts):
                of, start, end = spans(texts[a:b], weights)
                of = of + a
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(own[of])), pa.array(start + off[of]), pa.array(end + off[of])],
                    ["doc_id", "start_char", "end_char"],
                )

    return rows.mapInArrow(run, schema)
