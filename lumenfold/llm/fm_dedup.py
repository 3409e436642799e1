"""Substring deduplication with compressed FM-indexes.

A window of WINDOW words is removed wherever its word sequence also starts in a document with a smaller id. Windows are
routed by content: each has a minimiser among its GRAM-word shingles, equal windows have the same one, and consecutive
windows with one minimiser form a segment. Minimisers seen in one document only are dropped (first round). The segments
of the others go to the minimiser's shard, once per block and distinct segment. A shard joins its distinct segments to one
text, builds a suffix array of it, keeps the Burrows-Wheeler transform in a wavelet tree shaped by a prefix code (packed
bits with block counts, about the text's zero-order entropy) and streams every document's segments against it: backward
search extends each match to the left while more than one row is left. A match's statistic only matters up to the
threshold, where it is cut; those that reach it report the smallest document id, and a document's matches join to the
maximal intervals of repeated words that are reported and removed, whatever their lengths.

A minimiser with over HOT distinct segments (variants of one passage) is split: its windows travel on their own, each to
the shard of its own hash, so no shard holds such a group whole; results are the same.

Nulls: a null text has no words; a row with a null id neither removes nor loses words. Equal ids count as one document, so
repeated rows don't remove each other's words and each get their own result. An empty table gives an empty one; columns
that are kept travel under names of their own, so none clashes. Ids that aren't integers raise TypeError.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumenfold.llm import blocks as B
from lumenfold.llm.common import need_integers
from lumenfold.llm.tokens import grams, inside, mix, words

WINDOW, GRAM, HOT = 13, 5, 5000
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
#: Text per block: its index structures take about twenty times as much.
BLOCK_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 20), _BASE, np.uint64)], dtype=np.uint64)
    return _POWERS[:n]


_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_INVERSES = np.ones(1, np.uint64)


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words start..end of each span, by prefix sums."""
    global _INVERSES
    if len(_INVERSES) < len(h) + 1:
        _INVERSES = np.cumprod(np.r_[np.uint64(1), np.full(max(len(h) + 1, 1 << 20), _INVERSE, np.uint64)], dtype=np.uint64)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h)), out=total[1:])
    return mix((total[end] - total[start]) * _INVERSES[start] + (end - start).astype(np.uint64))


class Wavelet:
    """Rank queries on a sequence of integers: a wavelet tree in the shape of a prefix code (Shannon's code lengths, canonical
    order), so a symbol takes about its zero-order entropy. One packed bit vector per digit, nodes in the codes' order."""

    def __init__(self, seq: np.ndarray, sigma: int):
        count = np.bincount(seq, minlength=sigma)
        used = np.flatnonzero(count)
        self.size = np.zeros(sigma, np.int64)
        self.size[used] = np.maximum(1, np.ceil(np.log2(len(seq) / count[used]) - 1e-12)).astype(np.int64)
        order = used[np.lexsort((used, self.size[used]))]
        # canonical codes: the next number at each length
        self.code = np.zeros(sigma, np.int64)
        most = int(self.size.max()) if len(used) else 0
        code = np.cumsum(np.r_[0, np.int64(1) << (most - self.size[order])])[:-1]
        self.code[order] = code >> (most - self.size[order])
        self.bits, self.ones, self.start, self.base = [], [], [], []
        for d in range(most):
            seq = seq[self.size[seq] > d]
            bit = (self.code[seq] >> (self.size[seq] - 1 - d)) & 1
            raw = np.packbits(bit.astype(bool), bitorder="little")
            packed = np.concatenate([raw, np.zeros(8 + (-len(raw)) % 8, np.uint8)]).view(np.uint64)
            self.bits.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)]).astype(np.int32))
            # where each symbol's node begins at this level
            here = order[self.size[order] > d]
            prefix = self.code[here] >> (self.size[here] - d)
            before = np.cumsum(np.r_[0, count[here]])[:-1]
            first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            start = np.zeros(sigma, np.int32)
            start[here] = np.repeat(before[first], np.diff(np.r_[first, len(here)]))
            self.start.append(start)
            self.base.append(self._before(d, start).astype(np.int32))
            # into the order of the next level: stable by node
            seq = seq[np.argsort(self.code[seq] >> (self.size[seq] - 1 - d), kind="stable")]

    def _before(self, d: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        return self.ones[d][w] + np.bitwise_count(self.bits[d][w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def rank(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before lo and before hi; none of a symbol that doesn't occur."""
        size, code = self.size[symbol], self.code[symbol]
        lo, hi = np.where(size > 0, lo, 0), np.where(size > 0, hi, 0)
        live = np.arange(len(symbol))
        out_lo, out_hi = lo.copy(), hi.copy()
        for d in range(len(self.bits)):
            go = size > d
            if not go.all():
                done = ~go
                out_lo[live[done]], out_hi[live[done]] = lo[done], hi[done]
                live, lo, hi, size, code, symbol = live[go], lo[go], hi[go], size[go], code[go], symbol[go]
            if not len(live):
                break
            start, base = self.start[d][symbol], self.base[d][symbol]
            l1, h1 = self._before(d, start + lo) - base, self._before(d, start + hi) - base
            one = ((code >> (size - 1 - d)) & 1).astype(bool)
            lo, hi = np.where(one, l1, lo - l1), np.where(one, h1, hi - h1)
        out_lo[live], out_hi[live] = lo, hi
        return out_lo, out_hi


def first_documents(text: np.ndarray, owner: np.ndarray, query: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For windows of `text` (symbols from 1; 0 separates) that start at `query`: the smallest owner of an equal window.

    owner: a number per position of text.
    """
    n, sigma = len(text), int(text.max()) + 1
    # suffixes by their first `window` symbols or more: prefix doubling
    rank, width = text.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + sigma + 2) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        width *= 2
        if width >= window:
            break
    bwt = text[order - 1]
    tree = Wavelet(bwt, sigma)
    below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
    out = owner[query].copy()
    for a in range(0, len(query), 1 << 17):
        q = query[a : a + (1 << 17)]
        live = np.arange(len(q))
        c = text[q + window - 1]
        lo, hi = below[c], below[c + 1]
        for step in range(window - 2, -1, -1):
            more = hi - lo > 1  # a window that is alone is its own first
            live, lo, hi = live[more], lo[more], hi[more]
            if not len(live):
                break
            c = text[q[live] + step]
            l, h = tree.rank(c, lo, hi)
            lo, hi = below[c] + l, below[c] + h
        if len(live):
            # windows of one length have disjoint or equal intervals
            start, back = np.unique(lo, return_inverse=True)
            end = np.zeros(len(start), np.int64)
            end[back] = hi
            edges = np.stack([start, end], axis=1).ravel()
            least = np.minimum.reduceat(np.r_[owner[order], np.iinfo(np.int64).max], edges)[::2]
            out[a + live] = least[back]
    return out


class Segments:
    """Windows of a block's rows in id order, grouped by minimiser."""

    def __init__(self, t: pa.Table, window: int):
        self.h, self.first, *_ = words(t.column("text"), False)
        total = len(self.h)
        g = grams(self.h, GRAM)
        ok = inside(self.first, total, GRAM)
        whole = inside(self.first, total, window)
        n, span = len(whole), window - GRAM + 1
        if n:
            g = np.where(ok, g, np.uint64(0xFFFFFFFFFFFFFFFF))
            best, at = g[:n].copy(), np.zeros(n, np.int64)
            for j in range(1, span):
                less = g[j : j + n] < best
                best[less], at[less] = g[j : j + n][less], j
            start = np.flatnonzero(whole)
            anchor = start + at[start]
        else:
            start = anchor = np.zeros(0, np.int64)
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)] if len(start) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        self.start = start[begin]
        self.count = np.diff(np.r_[begin, len(start)])
        self.end = self.start + self.count + window - 1
        self.key = g[anchor[begin]] if len(begin) else np.zeros(0, np.uint64)
        self.row = np.searchsorted(self.first, self.start, "right") - 1
        self.hash = span_hash(self.h, self.start, self.end) if len(begin) else self.key
        ids = t.column("doc_id").to_pylist()
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)


def dedup(docs: DataFrame, keep: list[str] | None = None, window: int = WINDOW, hot: int = HOT, prefix: str = "") -> DataFrame:
    """The given columns (default doc_id) and, with the prefix before their names, n_words, n_removed, kept_sha256, kept
    (the words left, one space between) and spans (start and stop word of every removed interval)."""
    need_integers(docs)
    keep = keep or ["doc_id"]
    fields = {f.name: f for f in docs.schema.fields}
    # other columns travel under names of their own, so that none of theirs clashes
    own = {c: c if c in ("doc_id", "text") else f"k{i}" for i, c in enumerate(keep)}
    n = B.block_count(docs, BLOCK_BYTES)
    dealt = B.blocks(docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(a) for c, a in own.items() if a != c)), n)

    def ask_keys(t: pa.Table) -> pa.Table:
        block = t.column("__block")[0].as_py()
        s = Segments(B.in_order(t), window)
        use = s.known[s.row]
        key, hash_, doc = s.key[use], s.hash[use], s.ids[s.row[use]]
        # distinct segments of a minimiser, and whether two documents of this block hold it
        o = np.lexsort((hash_, key))
        key, hash_, doc = key[o], hash_[o], doc[o]
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        differ = new | np.r_[True, hash_[1:] != hash_[:-1]] if len(key) else new
        variants = np.add.reduceat(differ.astype(np.int64), at) if len(at) else at
        many = np.maximum.reduceat(doc, at) > np.minimum.reduceat(doc, at) if len(at) else new
        order, bounds = B.by_shard(key[at], n)
        k, v, m = key[at][order], np.minimum(variants[order], 65535).astype(np.uint16), many[order]
        return B.messages([(p, block, 0, B.pack(k[a:b], v[a:b], m[a:b])) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a])

    def count_keys(blobs: list[bytes]) -> list[bytes]:
        got = [B.unpack(x) for x in blobs]
        size = [len(g[0]) for g in got]
        key, back = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        variants = np.bincount(back, np.concatenate([g[1] for g in got]))
        docs_ = np.bincount(back) + np.bincount(back, np.concatenate([g[2] for g in got]))
        state = np.where(docs_ < 2, 0, np.where(variants > hot, 2, 1)).astype(np.uint8)[back]
        return [B.pack(x) for x in np.split(state, np.cumsum(size)[:-1])]

    def states(t: pa.Table, replies: pa.Table, s: Segments) -> np.ndarray:
        """0, 1 or 2 for every segment of the block."""
        key = np.unique(s.key[s.known[s.row]])
        order, _ = B.by_shard(key, n)
        got = sorted(zip(replies.column("dest").to_pylist(), replies.column("payload").to_pylist(), strict=True))
        state = np.zeros(len(key), np.uint8)
        if got:
            state[order] = np.concatenate([B.unpack(p)[0] for _, p in got])
        of = np.searchsorted(key, s.key)
        return np.where(s.known[s.row], np.append(state, 0)[np.minimum(of, len(key))], 0)

    def pieces_of(s: Segments, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pieces to be searched, in the order sent: (start, end, row, shard) and, for each of their windows'
        segments, how the block's own windows map to them: (window start, flat answer index)."""
        one, two = np.flatnonzero(state == 1), np.flatnonzero(state == 2)
        w_start = np.concatenate([np.arange(a, a + c) for a, c in zip(s.start[two], s.count[two], strict=True)]) if len(two) else np.zeros(0, np.int64)
        w_row = np.repeat(s.row[two], s.count[two])
        start, end = np.r_[s.start[one], w_start], np.r_[s.end[one], w_start + window]
        row = np.r_[s.row[one], w_row]
        w_hash = span_hash(s.h, w_start, w_start + window) if len(two) else np.zeros(0, np.uint64)
        hash_, route = np.r_[s.hash[one], w_hash], np.r_[s.key[one], w_hash]
        shard = B.shard_of(route, n)
        o = np.lexsort((s.ids[row], hash_, shard))
        start, end, row, hash_, shard = start[o], end[o], row[o], hash_[o], shard[o]
        new = np.r_[True, (hash_[1:] != hash_[:-1]) | (shard[1:] != shard[:-1])] if len(o) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        windows = end - start - window + 1
        base = np.cumsum(np.r_[0, windows[at]])
        return start, windows, row, base[which] if len(o) else which, at, shard

    def ask_segments(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return B.messages([])
        block = left.column("__block")[0].as_py()
        s = Segments(B.in_order(left), window)
        state = states(left, right, s)
        start, windows, row, _, at, shard = pieces_of(s, state)
        out = [(-1 - block, block, -1, B.pack(state))]
        start, size, doc, shard = start[at], windows[at] + window - 1, s.ids[row[at]], shard[at]
        bounds = np.searchsorted(shard, np.arange(n + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[p], bounds[p + 1]
            flat = np.repeat(start[a:b] - np.cumsum(np.r_[0, size[a : b - 1]]), size[a:b]) + np.arange(size[a:b].sum())
            word, index = np.unique(s.h[flat], return_inverse=True)
            out.append((int(p), block, 0, B.pack(word, B.narrow(index), size[a:b].astype(np.uint8), doc[a:b])))
        return B.messages(out)

    def search(blobs: list[bytes]) -> list[bytes]:
        got = [B.unpack(x) for x in blobs]
        word = np.unique(np.concatenate([g[0] for g in got]))
        flat = np.concatenate([np.searchsorted(word, g[0])[g[1]] + 1 for g in got])
        size = np.concatenate([g[2] for g in got]).astype(np.int64)
        doc = np.concatenate([g[3] for g in got])
        begin = np.cumsum(size) - size
        # distinct segments are indexed once, with their smallest document
        hash_ = span_hash(mix(flat.astype(np.uint64)), begin, begin + size)
        o = np.lexsort((doc, hash_))
        new = np.r_[True, hash_[o][1:] != hash_[o][:-1]]
        own = o[new]
        piece = np.empty(len(o), np.int64)
        piece[o] = np.cumsum(new) - 1
        length = size[own]
        put = np.cumsum(length + 1) - (length + 1)
        text = np.zeros(int((length + 1).sum()) + 1, np.int64)
        source = np.repeat(begin[own] - np.cumsum(np.r_[0, length[:-1]]), length) + np.arange(length.sum())
        target = np.repeat(put - np.cumsum(np.r_[0, length[:-1]]), length) + np.arange(length.sum())
        text[target] = flat[source]
        owner = np.zeros(len(text), np.int64)
        owner[target] = np.repeat(doc[own], length)
        windows = length - window + 1
        query = np.repeat(put - np.cumsum(np.r_[0, windows[:-1]]), windows) + np.arange(windows.sum())
        least = first_documents(text, owner, query, window)
        base = np.cumsum(np.r_[0, windows])
        out, at = [], 0
        for g in got:
            mine = piece[at : at + len(g[2])]
            at += len(g[2])
            w = windows[mine]
            idx = np.repeat(base[mine] - np.cumsum(np.r_[0, w[:-1]]), w) + np.arange(w.sum())
            out.append(B.pack(least[idx]))
        return out

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        t = B.in_order(left) if left.num_rows else left
        if not left.num_rows:
            return out_schema.empty_table()
        s = Segments(t, window)
        rows = sorted(zip(right.column("dest").to_pylist(), right.column("payload").to_pylist(), strict=True))
        state = B.unpack(rows[0][1])[0]
        least = np.concatenate([B.unpack(p)[0] for d, p in rows if d >= 0] or [np.zeros(0, np.int64)])
        start, windows, row, answer, _, _ = pieces_of(s, state)
        rep = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        w_start, w_answer = np.repeat(start, windows) + rep, np.repeat(answer, windows) + rep
        gone = least[w_answer] < s.ids[np.repeat(row, windows)]
        mark = np.zeros(len(s.h) + 1, np.int64)
        np.add.at(mark, w_start[gone], 1)
        np.add.at(mark, w_start[gone] + window, -1)
        drop = np.cumsum(mark)[:-1] > 0
        removed = np.add.reduceat(np.r_[drop, False].astype(np.int64), np.minimum(s.first[:-1], len(drop))) * (np.diff(s.first) > 0)
        kept, spans = [], []
        for r, text in enumerate(t.column("text").to_pylist()):
            w = (text or "").encode().split()
            if removed[r]:
                w = compress(w, (~drop[s.first[r] : s.first[r + 1]]).tolist())
                edge = np.flatnonzero(np.diff(np.r_[0, drop[s.first[r] : s.first[r + 1]].astype(np.int8), 0]))
                spans.append([{"start": a, "stop": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
            else:
                spans.append([])
            kept.append(b" ".join(w))
        cols = [*(t.column(own[c]) for c in keep), pa.array(np.diff(s.first)), pa.array(removed), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k.decode() for k in kept], pa.string()), pa.array(spans, _SPANS)]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], names)

    names = [*keep, *(prefix + c for c in ("n_words", "n_removed", "kept_sha256", "kept", "spans"))]
    schema = T.StructType([*(T.StructField(c, fields[c].dataType) for c in keep), *(T.StructField(c, k) for c, k in zip(names[-5:], (T.LongType(), T.LongType(), T.StringType(), T.StringType(), SPANS), strict=True))])
    out_schema = to_arrow_schema(schema)
    keys = B.answer(dealt.groupBy("__block").applyInArrow(ask_keys, B.MESSAGES), count_keys, n)
    asked = dealt.groupBy("__block").cogroup(B.back(keys, n)).applyInArrow(ask_segments, B.MESSAGES)
    found = B.answer(asked, search, n)
    return dealt.groupBy("__block").cogroup(B.back(found, n)).applyInArrow(finish, schema)
