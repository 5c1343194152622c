"""String kernels that Spark lacks, as Arrow-batched UDFs; each batch computes distinct inputs once, pairs of texts side by side in arrays."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOWELS = set("AEIOU")


#: Pairs whose characters are held side by side, in cells.
CELLS = 1 << 19


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, a row each, filled up with zeros; and the lengths."""
    sizes = np.array([len(t) for t in texts], np.int64)
    width = max(1, int(sizes.max()))
    return np.array(texts, f"U{width}").view(np.uint32).reshape(len(texts), width), sizes


def _in_chunks(a: list[str], b: list[str], fn) -> np.ndarray:
    """``fn`` of lists of pairs of like length, so that few cells are filling."""
    widest = [max(len(x), len(y)) for x, y in zip(a, b, strict=True)]
    order = np.argsort(widest, kind="stable")
    out = np.zeros(len(order))
    at = 0
    while at < len(order):
        # The chunk's last pair is its widest.
        to = min(len(order), at + CELLS)
        while to > at + 1 and (to - at) * widest[order[to - 1]] > CELLS:
            to = at + (to - at + 1) // 2
        chunk = order[at:to]
        out[chunk] = fn([a[k] for k in chunk], [b[k] for k in chunk])
        at = to
    return out


def _jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    x, n = _codes(a)
    y, m = _codes(b)
    at = np.arange(y.shape[1])
    reach = np.maximum(0, np.maximum(n, m) // 2 - 1)[:, None]
    free = at < m[:, None]
    taken = np.zeros(x.shape, bool)
    every = np.arange(len(x))
    for i in range(x.shape[1]):
        ok = free & (y == x[:, i, None]) & (np.abs(at - i) <= reach) & (i < n)[:, None]
        first = ok.argmax(axis=1)
        taken[:, i] = found = ok[every, first]
        free[every[found], first[found]] = False
    k = taken.sum(axis=1)
    width = min(x.shape[1], y.shape[1])
    left = np.take_along_axis(x, np.argsort(~taken, axis=1, kind="stable"), axis=1)[:, :width]
    right = np.take_along_axis(y, np.argsort(free | (at >= m[:, None]), axis=1, kind="stable"), axis=1)[:, :width]
    half = ((left != right) & (np.arange(width) < k[:, None])).sum(axis=1) // 2
    jaro = np.where(k > 0, (k / n + k / m + (k - half) / np.maximum(k, 1)) / 3, 0.0)
    four = min(4, width)
    same = (x[:, :four] == y[:, :four]) & (np.arange(four) < np.minimum(n, m)[:, None])
    prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    """Jaro similarity of pairs of texts that are not empty, raised for a common prefix of up to four where it is above 0.7."""
    return _in_chunks(a, b, _jaro_winkler)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word or more of columns at a time."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    a, b = zip(*(sorted(p, key=len) for p in zip(a, b, strict=True)), strict=True)
    if max(map(len, a)) > 64:
        return np.array([common_subsequence(*p) for p in zip(a, b, strict=True)])
    x, n = _codes(a)
    y, m = _codes(b)
    # One machine word holds a pair's columns.
    cells = np.zeros((len(x), 64), bool)
    row = np.full(len(x), np.iinfo(np.uint64).max)
    inside = np.arange(x.shape[1]) < n[:, None]
    for j in range(y.shape[1]):
        cells[:, : x.shape[1]] = (x == y[:, j, None]) & inside & (j < m)[:, None]
        hit = row & np.packbits(cells, axis=1, bitorder="little").view(np.uint64)[:, 0]
        row = (row + hit) | (row - hit)
    return np.bitwise_count(~row)


def common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs of texts."""
    return _in_chunks(a, b, _common_subsequences)


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Of two token sets: what they share against each with what it has alone; the best of the three ratios, up to 100."""
    known = {t: sorted(set(t.split())) for t in {*a, *b}}
    both = [(known[x], known[y]) for x, y in zip(a, b, strict=True)]
    shared = [set(x).intersection(y) for x, y in both]
    only_a, only_b = ([" ".join([t for t in p[k] if t not in c]) for p, c in zip(both, shared, strict=True)] for k in (0, 1))
    size = np.array([sum(map(len, c)) + max(0, len(c) - 1) for c in shared])
    p, q = (np.array([len(t) for t in texts]) for texts in (only_a, only_b))
    gap = (size > 0).astype(int)
    la, lb = size + gap + p, size + gap + q
    apart = p + q - 2 * common_subsequences(only_a, only_b)
    with np.errstate(invalid="ignore", divide="ignore"):
        best = 100 * (1 - apart / (la + lb))
        best = np.where(gap > 0, np.maximum(best, np.maximum(100 * (1 - (gap + p) / (size + la)), 100 * (1 - (gap + q) / (size + lb)))), best)
    best = np.where((gap > 0) & ((p == 0) | (q == 0)), 100.0, best)
    return np.where([bool(x and y) for x, y in both], best, 0.0)


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Twice the longest common subsequence of the sorted tokens over both lengths, up to 100."""
    a, b = ([" ".join(sorted(t.split())) for t in side] for side in (a, b))
    total = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)])
    return np.where(total > 0, 200 * common_subsequences(a, b) / np.maximum(total, 1), 0.0)


def token_overlaps(a: list[str], b: list[str]) -> np.ndarray:
    """Shared tokens over the smaller set of tokens of texts that are not empty."""
    sets = [(set(x.split(" ")), set(y.split(" "))) for x, y in zip(a, b, strict=True)]
    return np.array([len(x & y) / min(len(x), len(y)) for x, y in sets])


def nysiis_of(text: str) -> str:
    """The published NYSIIS code of the letters of a text; '' below three characters."""
    if len(text) < 3:
        return ""
    s = "".join(c for c in text.upper() if "A" <= c <= "Z")
    if not s:
        return ""
    for old, new in (("MAC", "MCC"), ("KN", "NN"), ("K", "C"), ("PH", "FF"), ("PF", "FF"), ("SCH", "SSS")):
        if s.startswith(old):
            s = new + s[len(old) :]
            break
    for old, new in (("EE", "Y"), ("IE", "Y"), ("DT", "D"), ("RT", "D"), ("RD", "D"), ("NT", "D"), ("ND", "D")):
        if s.endswith(old):
            s = s[: -len(old)] + new
            break
    code, i = s[0], 1
    c = list(s)
    while i < len(c):
        rest = "".join(c[i : i + 3])
        if rest[:2] == "EV":
            c[i : i + 2] = "AF"
        elif c[i] in VOWELS:
            c[i] = "A"
        elif c[i] in "QZM":
            c[i] = {"Q": "G", "Z": "S", "M": "N"}[c[i]]
        elif rest[:2] == "KN":
            c[i : i + 2] = "NN"
        elif c[i] == "K":
            c[i] = "C"
        elif rest == "SCH":
            c[i : i + 3] = "SSS"
        elif rest[:2] == "PH":
            c[i : i + 2] = "FF"
        elif c[i] == "H" and (c[i - 1] not in VOWELS or (i + 1 < len(c) and c[i + 1] not in VOWELS)):
            c[i] = c[i - 1]
        elif c[i] == "W" and c[i - 1] in VOWELS:
            c[i] = c[i - 1]
        if c[i] != code[-1]:
            code += c[i]
        i += 1
    if len(code) > 1 and code.endswith("S"):
        code = code[:-1]
    if code.endswith("AY"):
        code = code[:-2] + "Y"
    if len(code) > 1 and code.endswith("A"):
        code = code[:-1]
    return code


def folded_exactly(text: str) -> str:
    """Compatibility form without any combining mark."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _distinct(a: pa.Array, b: pa.Array):
    """The distinct pairs of texts that are not NULL: texts of both sides, a place in them for each pair, the pairs' rows and each row's pair."""
    a, b = (x.cast(pa.string()).dictionary_encode() for x in (a, b))
    known = np.logical_and(*(np.asarray(x.is_valid()) for x in (a, b)))
    i, j = (x.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
    width = max(1, len(b.dictionary))
    pairs, where = np.unique(i[known] * width + j[known], return_inverse=True)
    return a.dictionary.to_pylist(), b.dictionary.to_pylist(), pairs // width, pairs % width, known, where


def _pairwise(fn):
    @F.arrow_udf(T.DoubleType())
    def kernel(a: pa.Array, b: pa.Array) -> pa.Array:
        left, right, i, j, known, where = _distinct(a, b)
        both = [(left[x], right[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)]
        full = np.array([bool(x and y) for x, y in both], bool)
        found = np.zeros(len(both))
        if full.any():
            found[full] = fn(*map(list, zip(*(p for p in both if p[0] and p[1]), strict=True)))
        out, none = np.zeros(len(known)), np.ones(len(known), bool)
        out[known], none[known] = found[where], ~full[where]
        return pa.array(out, mask=none)

    return kernel


#: Pairs held side by side, so that a step's arrays stay in the cache; cells of the table that tells where a text has a character.
PAIRS, TABLE = 1 << 12, 1 << 20


def _edits(where: np.ndarray, base: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Edit distances of pairs, the longest right texts first: 64 rows of a pair's table in a word (Myers' and Hyyro's steps).

    ``where``: bits of the places that a left text (at ``base``) has a letter at; ``y``: the right texts' letters, a column each.
    """
    words, full = len(where), np.iinfo(np.uint64).max
    one, top = np.uint64(1), np.uint64(63)
    up, down = np.full((words, len(n)), full), np.zeros((words, len(n)), np.uint64)
    hit, xv, xh, rest = (np.empty(len(n), np.uint64) for _ in range(4))
    for k in range(len(y)):
        to = int(np.searchsorted(-m, -k, side="left"))
        if not to:
            break
        at = base[:to] + y[k, :to]
        h, v, x, r = hit[:to], xv[:to], xh[:to], rest[:to]
        plus, minus = one, None
        for w in range(words):
            pv, mv = up[w, :to], down[w, :to]
            np.take(where[w], at, out=h, mode="clip")
            np.bitwise_or(h, mv, out=v)
            if minus is not None:
                h |= minus
            np.bitwise_and(h, pv, out=x)
            x += pv
            x ^= pv
            x |= h
            np.bitwise_or(x, pv, out=r)
            np.invert(r, out=r)
            r |= mv
            x &= pv
            over = (r >> top, x >> top) if w + 1 < words else (None, None)
            r <<= one
            r |= plus
            x <<= one
            if minus is not None:
                x |= minus
            np.bitwise_and(r, v, out=mv)
            np.bitwise_or(r, v, out=r)
            np.invert(r, out=r)
            np.bitwise_or(x, r, out=pv)
            plus, minus = over
    # The last column's steps up and down lead from its top, the right text's length, to the distance.
    out = m.astype(np.int64)
    for w in range(words):
        own = np.clip(n - 64 * w, 0, 64)
        kept = np.where(own < 64, (one << np.minimum(own, 63).astype(np.uint64)) - one, full)
        out += np.bitwise_count(up[w] & kept).astype(np.int64) - np.bitwise_count(down[w] & kept).astype(np.int64)
    return out


def edit_distances(left: list[str], right: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Edit distances, in code points, of the pairs (left[i], right[j])."""
    if not len(i):
        return np.zeros(0, np.int64)
    if len(left) > len(right):
        left, right, i, j = right, left, j, i
    x, n = _codes(left)
    y, m = _codes(right)
    known = np.zeros(1 + int(max(x.max(), y.max())), bool)
    known[x], known[y] = True, True
    number = np.cumsum(known) - 1
    x, y, letters = number[x], number[y], int(number[-1]) + 1
    out = np.zeros(len(i), np.int64)
    # Left texts of one width share a table; as many of them as its cells allow.
    wide = np.maximum(1, -(-n // 64))
    for words in np.unique(wide).tolist():
        some = np.flatnonzero(wide == words)
        step = max(1, TABLE // (letters * words))
        for first in range(0, len(some), step):
            mine = some[first : first + step]
            place = np.full(len(left), -1)
            place[mine] = np.arange(len(mine))
            where = np.zeros((words, len(mine), letters), np.uint64)
            for k in range(int(n[mine].max())):
                inside = np.flatnonzero(k < n[mine])
                where[k // 64, inside, x[mine[inside], k]] |= np.uint64(1 << k % 64)
            where = where.reshape(words, -1)
            rows = np.flatnonzero(place[i] >= 0)
            rows = rows[np.argsort(-m[j[rows]], kind="stable")]
            for at in range(0, len(rows), PAIRS):
                part = rows[at : at + PAIRS]
                a, b = i[part], j[part]
                out[part] = _edits(where, place[a] * letters, n[a], np.ascontiguousarray(y[b, : max(1, int(m[b].max()))].T), m[b])
    return out


@F.arrow_udf(T.IntegerType())
def levenshtein(a: pa.Array, b: pa.Array) -> pa.Array:
    left, right, i, j, known, where = _distinct(a, b)
    out = np.zeros(len(known), np.int32)
    out[known] = edit_distances(left, right, i, j)[where]
    return pa.array(out, mask=~known)


def _single(fn):
    @F.pandas_udf(T.StringType())
    def kernel(a: pd.Series) -> pd.Series:
        known = {x: fn(x) if x else None for x in a.unique()}
        return a.map(known)

    return kernel


jaro_winkler = _pairwise(jaro_winklers)
token_set_ratio = _pairwise(token_set_ratios)
token_sort_ratio = _pairwise(token_sort_ratios)
token_overlap = _pairwise(token_overlaps)
nysiis = _single(nysiis_of)
fold_exactly = _single(folded_exactly)


def levenshtein_ratio(a, b):
    """One minus the edit distance over the longer length; NULL if either is missing."""
    return F.lit(1.0) - levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def haversine_km(lat1, lon1, lat2, lon2):
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * 6371.0088) * F.asin(F.sqrt(F.least(F.lit(1.0), half)))


def soundex_of(col):
    """Soundex of the first Latin token; NULL without one."""
    word = F.regexp_extract(col, "([a-z]+)", 1)
    return F.when(word != "", F.soundex(word))
