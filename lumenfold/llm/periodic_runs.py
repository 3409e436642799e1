"""Periodic runs of words: maximal stretches that repeat with some period at least twice, found in n log n comparisons.

A run of length L and smallest period q has L >= max(shortest, 2 q), so its two copies shifted by q overlap in at least
k = ceil(shortest / 2) words, and every word of it lies in a k-gram that occurs again in the same document. Words outside
such repeated k-grams are masked; what is left falls into segments, and only segments of `shortest` words or more are
searched, by the divide and conquer of Main and Lorentz: a run that crosses the middle of a part pairs that middle with the
word one period before or behind it, and the longest common extensions of the pair in both directions give the run whole.
All parts of one depth of all documents of a batch are searched at once; extensions come from hashes of stretches of 2^j
words, so a word is never compared twice for one pair.

A document is searched whole by the task that reads it: no shuffle, no table of other documents. Null and empty texts have
no words and no runs; a null id counts as the empty text where the id is hashed; repeated rows get equal results each; an
empty table gives an empty one; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import by_piece
from lumenfold.llm.tokens import MUL, grams, inside, mix, words

SHORTEST = 12
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... size - 1 of each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def survivors(h: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Whether each word lies in a k-gram that occurs more than once in its own row."""
    out = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(inside(first, len(h), k))
    if not len(at):
        return out[:-1] > 0
    row = np.searchsorted(first, at, "right").astype(np.uint64)
    g = mix(grams(h, k)[at] + row * MUL)
    order = np.argsort(g, kind="stable")
    same = g[order[1:]] == g[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    np.add.at(out, at[again], 1)
    np.add.at(out, at[again] + k, -1)
    return np.cumsum(out[:-1]) > 0


class Extensions:
    """Longest common extensions of pairs of places of one array, by hashes of stretches of 2^j entries."""

    def __init__(self, h: np.ndarray, longest: int):
        self.levels = [h]
        while 2 << (len(self.levels) - 1) <= longest:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(mix(last[:-half] * MUL + last[half:]))

    def forward(self, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many entries from a and b on are equal, b staying below end (a < b)."""
        a, to = a.copy(), b.copy()
        for j in reversed(range(len(self.levels))):
            i = np.flatnonzero(to + (1 << j) <= end)
            i = i[self.levels[j][a[i]] == self.levels[j][to[i]]]
            a[i] += 1 << j
            to[i] += 1 << j
        return to - b

    def backward(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many entries before a and b are equal, a staying at or above begin."""
        to, b = a.copy(), b.copy()
        for j in reversed(range(len(self.levels))):
            i = np.flatnonzero(to - (1 << j) >= begin)
            i = i[self.levels[j][to[i] - (1 << j)] == self.levels[j][b[i] - (1 << j)]]
            to[i] -= 1 << j
            b[i] -= 1 << j
        return a - to


def main_lorentz(h: np.ndarray, begin: np.ndarray, end: np.ndarray, shortest: int) -> np.ndarray:
    """(start, end, smallest period) rows, sorted, of all runs within the given segments of an array of hashes."""
    found = [np.zeros((0, 3), np.int64)]
    ext = Extensions(h, int((end - begin).max(initial=0)))
    part = np.stack([begin, end, begin, end], axis=1)  # a part and the segment that it is of
    while len(part):
        part = part[part[:, 1] - part[:, 0] >= shortest]
        low, high = part[:, 0], part[:, 1]
        mid = (low + high) // 2
        left, right = mid - low, high - mid - 1
        a = np.concatenate([np.repeat(low, left) + ramp(left), np.repeat(mid, right)])
        b = np.concatenate([np.repeat(mid, left), np.repeat(mid + 1, right) + ramp(right)])
        of = np.concatenate([np.repeat(np.arange(len(part)), left), np.repeat(np.arange(len(part)), right)])
        # the pair of a run that crosses the middle lies within it, so the two words are equal
        same = h[a] == h[b]
        a, b, of = a[same], b[same], of[same]
        ahead, back = ext.forward(a, b, part[of, 3]), ext.backward(a, b, part[of, 2])
        run = (ahead + back >= b - a) & (ahead + back + b - a >= shortest)
        found.append(np.stack([(a - back)[run], (b + ahead)[run], (b - a)[run]], axis=1))
        part = np.concatenate([np.stack([low, mid, part[:, 2], part[:, 3]], axis=1), np.stack([mid, high, part[:, 2], part[:, 3]], axis=1)])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # multiples of a run's period give the same stretch once more
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def runs_of(h: np.ndarray, first: np.ndarray, shortest: int) -> np.ndarray:
    """(start, end, period) rows of all runs of all rows of a batch of words, by start, then period."""
    alive = survivors(h, first, -(-shortest // 2))
    # a segment ends with its row
    edge = np.diff(np.concatenate([[0], alive.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = first[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(h))])
    cuts = cuts[alive[cuts] & alive[cuts - 1]]
    begin, end = np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts]))
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    size = end - begin
    at = np.repeat(begin, size) + ramp(size)
    low = np.cumsum(size) - size
    runs = main_lorentz(h[at], low, low + size, shortest)
    if len(runs):
        move = (begin - low)[np.searchsorted(low, runs[:, 0], "right") - 1]
        runs[:, :2] += move[:, None]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_mask(n: int, runs: np.ndarray) -> np.ndarray:
    """False for the words of runs behind their first period."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, runs[:, 0] + runs[:, 2], 1)
    np.add.at(d, runs[:, 1], -1)
    return np.cumsum(d[:-1]) == 0


def by_document(texts: pa.Array, shortest: int, salts: list[int] | None = None) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """(runs as rows of start, length, period; words; which words are kept) of every text. With salts, words are first
    repeated by plant()."""
    h, first, *_ = words(texts, False)
    origin = None
    if salts is not None:
        origin = np.concatenate([plant(int(n), s) for n, s in zip(np.diff(first), salts, strict=True)] or [np.zeros(0, np.int64)])
        h = h[origin + np.repeat(first[:-1], np.diff(first))]
    runs = runs_of(h, first, shortest)
    keep = kept_mask(len(h), runs)
    bounds = np.searchsorted(runs[:, 0], first)
    for r, text in enumerate(texts.to_pylist()):
        own = (text or "").encode().split()  # the same white space as that of words()
        at, to = first[r], first[r + 1]
        if origin is not None:
            own = [own[i] for i in origin[at:to]]
        mine = runs[bounds[r] : bounds[r + 1]]
        yield np.stack([mine[:, 0] - at, mine[:, 1] - mine[:, 0], mine[:, 2]], axis=1), own, keep[at:to]


def plant(n: int, salt: int) -> np.ndarray:
    """Which of n words stands at each place when the tail of every tenth text (by its salt) is made periodic."""
    out = np.arange(n)
    g = salt // 10
    if salt % 10 == 0 and n:
        a = g % n
        out[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return out


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start, then period) and collapsed (the words outside the repeats,
    joined by one space) of every row."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        runs, texts = [], []
        for own, w, keep in by_document(b.column(1), shortest):
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
            texts.append(b" ".join(compress(w, keep)).decode())
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(runs, kind), pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(by_piece(one), f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def digest(docs: DataFrame) -> DataFrame:
    """Counts, the longest run and hashes of every row, the tails of a tenth of the texts made periodic first."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for own, w, keep in by_document(b.column(1), SHORTEST, b.column(2).to_pylist()):
            best = own[np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]].tolist() if len(own) else [None] * 3
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in own.tolist())
            text = b" ".join(compress(w, keep))
            out.append((len(w), len(own), *best, 1000 * best[1] // best[2] if len(own) else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), int(keep.sum())))
        cols = list(zip(*out, strict=True))
        names = ["n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_kept"]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string() if n.endswith("256") else pa.int64()) for c, n in zip(cols, names, strict=True))], ["doc_id", *names])

    kind = dict(docs.dtypes)["doc_id"]
    salt = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", "text", salt.alias("salt")).mapInArrow(
        by_piece(one), f"doc_id {kind}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_kept long"
    )
