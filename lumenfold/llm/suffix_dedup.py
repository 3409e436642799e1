"""Repeated passages by sparse suffix arrays.

Suffixes are retained only at minimiser positions: the smallest hash of GRAM words among every SPAN neighbouring ones, so
equal passages retain equal positions and any GRAM + SPAN - 1 words hold one. A suffix whose first HEAD words occur in one
document only cannot start a repeat (first round, one key per block and suffix). The others go to the shard of that key
with the words around them. The shard sorts its suffixes, takes longest common prefixes of neighbours, and for every right
length from HEAD to LENGTH sorts each run of equal prefixes by the words to the left: neighbours that agree far enough
left are matches of LENGTH words or more, which is exact because equal windows are adjacent in that order. Matches reach
over all suffixes that they contain, so their union in a document is the whole repeated passage.

Suffixes with over HOT distinct surroundings travel as single windows, each to its own hash's shard, so no shard holds
such a group whole. Passages repeat across documents; repeats within one document don't count. Null or shorter texts and
rows with a null id have no repeats; equal ids count as one document, and repeated rows each get their own result. An empty
table gives an empty one; other columns are not read, whatever their names. Ids that aren't integers raise TypeError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm import blocks as B
from lumenfold.llm.common import need_integers
from lumenfold.llm.fm_dedup import span_hash
from lumenfold.llm.tokens import grams, inside, mix, words

LENGTH, GRAM, SPAN, HOT = 50, 8, 17, 5000
LEFT = SPAN - 1
HEAD = LENGTH - LEFT - 2
WIDTH = LEFT + LENGTH


class Suffixes:
    """Retained suffixes of a block's rows in id order."""

    def __init__(self, t: pa.Table):
        self.h, self.first, *_ = words(t.column("text"), False)
        total = len(self.h)
        g = grams(self.h, GRAM)
        at = np.zeros(0, np.int64)
        n = len(g) - SPAN + 1
        if n > 0:
            g = np.where(inside(self.first, total, GRAM), g, np.uint64(0xFFFFFFFFFFFFFFFF))
            best, shift = g[:n].copy(), np.zeros(n, np.int64)
            for j in range(1, SPAN):
                less = g[j : j + n] < best
                best[less], shift[less] = g[j : j + n][less], j
            begin = np.flatnonzero(inside(self.first, total, GRAM + SPAN - 1))
            at = np.unique(begin + shift[begin])
        row = np.searchsorted(self.first, at, "right") - 1
        ids = t.column("doc_id").to_pylist()
        known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        use = known[row] & (at + HEAD <= self.first[row + 1])
        self.at, self.row = at[use], row[use]
        self.key = span_hash(self.h, self.at, self.at + HEAD)
        # what surrounds a suffix, as far as its text goes
        self.low = np.maximum(self.at - LEFT, self.first[self.row])
        self.high = np.minimum(self.at + LENGTH, self.first[self.row + 1])
        self.around = mix(span_hash(self.h, self.low, self.high) ^ (self.at - self.low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def find_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Rows with a passage of LENGTH words or more that another document has too: doc_id, n_words, n_repeated (words of
    such passages), n_removable (those whose every window also starts in a smaller id: a later copy), spans."""
    need_integers(docs)
    n = B.block_count(docs)
    dealt = B.blocks(docs.select("doc_id", "text"), n)
    kind = dict(docs.dtypes)["doc_id"]

    def ask_keys(t: pa.Table) -> pa.Table:
        block = t.column("__block")[0].as_py()
        s = Suffixes(B.in_order(t))
        o = np.lexsort((s.around, s.key))
        key, around, doc = s.key[o], s.around[o], s.ids[s.row[o]]
        if not len(key):
            return B.messages([])
        new = np.r_[True, key[1:] != key[:-1]]
        at = np.flatnonzero(new)
        variants = np.add.reduceat((new | np.r_[True, around[1:] != around[:-1]]).astype(np.int64), at)
        low, high = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
        order, bounds = B.by_shard(key[at], n)
        parts = [x[order] for x in (key[at], np.minimum(variants, 65535).astype(np.uint16), high > low)]
        return B.messages([(int(p), block, 0, B.pack(*(x[bounds[p] : bounds[p + 1]] for x in parts))) for p in np.flatnonzero(np.diff(bounds))])

    def count_keys(blobs: list[bytes]) -> list[bytes]:
        got = [B.unpack(x) for x in blobs]
        _, back = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        variants = np.bincount(back, np.concatenate([g[1] for g in got]))
        seen = np.bincount(back) + np.bincount(back, np.concatenate([g[2] for g in got]))
        state = np.where(seen < 2, 0, np.where(variants > hot, 2, 1)).astype(np.uint8)[back]
        return [B.pack(x) for x in np.split(state, np.cumsum([len(g[0]) for g in got])[:-1])]

    def states(replies: pa.Table, s: Suffixes) -> np.ndarray:
        key = np.unique(s.key)
        order, _ = B.by_shard(key, n)
        state = np.zeros(len(key), np.uint8)
        got = sorted(zip(replies.column("dest").to_pylist(), replies.column("payload").to_pylist(), strict=True))
        if got:
            state[order] = np.concatenate([B.unpack(p)[0] for _, p in got])
        return state[np.searchsorted(key, s.key)] if len(key) else state

    def entries(s: Suffixes, state: np.ndarray):
        """In the order sent: word bounds and suffix place of each, its row, its shard, and which distinct entry it is."""
        one, two = np.flatnonzero(state == 1), np.flatnonzero(state == 2)
        # windows of a hot suffix: every start from which LENGTH words hold it
        start = np.concatenate([np.arange(a, b + 1) for a, b in zip(s.low[two], np.minimum(s.at[two], s.first[s.row[two] + 1] - LENGTH), strict=True)] or [np.zeros(0, np.int64)]).astype(np.int64)
        start = np.unique(start)
        w_row = np.searchsorted(s.first, start, "right") - 1
        low, at, high = np.r_[s.low[one], start], np.r_[s.at[one], start], np.r_[s.high[one], start + LENGTH]
        row = np.r_[s.row[one], w_row]
        w_hash = span_hash(s.h, start, start + LENGTH)
        hash_ = np.r_[s.around[one], w_hash]
        shard = B.shard_of(np.r_[s.key[one], w_hash], n)
        o = np.lexsort((s.ids[row], hash_, shard))
        low, at, high, row, hash_, shard = (x[o] for x in (low, at, high, row, hash_, shard))
        new = np.r_[True, (hash_[1:] != hash_[:-1]) | (shard[1:] != shard[:-1])] if len(o) else np.zeros(0, bool)
        return low, at, high, row, shard, np.flatnonzero(new), np.cumsum(new) - 1

    def ask_suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return B.messages([])
        block = left.column("__block")[0].as_py()
        s = Suffixes(B.in_order(left))
        state = states(right, s)
        low, at, high, row, shard, first, which = entries(s, state)
        out = [(-1 - block, block, -1, B.pack(state))]
        doc = s.ids[row]
        several = doc[np.r_[first[1:], len(doc)] - 1] > doc[first] if len(first) else np.zeros(0, bool)
        low, at, high, doc, shard = low[first], at[first], high[first], doc[first], shard[first]
        bounds = np.searchsorted(shard, np.arange(n + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            i = slice(bounds[p], bounds[p + 1])
            size = high[i] - low[i]
            flat = np.repeat(low[i] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            word, index = np.unique(s.h[flat], return_inverse=True)
            out.append((int(p), block, 0, B.pack(word, B.narrow(index), (at[i] - low[i]).astype(np.uint8), (high[i] - at[i]).astype(np.uint8), doc[i], several[i])))
        return B.messages(out)

    def compare(blobs: list[bytes]) -> list[bytes]:
        """Two bit masks per entry: for each left length, whether its window is in another document, and in a smaller id."""
        got = [B.unpack(x) for x in blobs]
        word = np.unique(np.concatenate([g[0] for g in got]))
        flat = np.concatenate([np.searchsorted(word, g[0])[g[1]] for g in got]) + 1
        left, right, doc, several = (np.concatenate([g[i] for g in got]) for i in (2, 3, 4, 5))
        left, right = left.astype(np.int64), right.astype(np.int64)
        begin = np.cumsum(left + right) - (left + right) + left
        step = np.arange(LENGTH)
        after = np.where(step < right[:, None], flat[np.minimum(begin[:, None] + step, len(flat) - 1)], 0).astype(">u4")
        back = np.arange(1, LEFT + 1)
        before = np.where(back <= left[:, None], flat[np.maximum(begin[:, None] - back, 0)], 0).astype(">u4")
        # the sparse suffix array and the common prefixes of neighbours
        order = np.argsort(np.ascontiguousarray(after).view(f"V{4 * LENGTH}").ravel(), kind="stable")
        a = after[order]
        same = a[1:] == a[:-1]
        common = np.where(same.all(axis=1), LENGTH, np.argmin(same, axis=1)) if len(order) > 1 else np.zeros(0, np.int64)
        b = before[order]
        hit, later = np.zeros(len(order), np.uint32), np.zeros(len(order), np.uint32)
        d, many, l_, r_ = doc[order], several[order], left[order], right[order]
        prefix = np.zeros(len(order), np.uint64)  # of the words to the left, nearest first
        for o in range(LEFT + 1):
            if o:
                prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + b[:, o - 1].astype(np.uint64) + np.uint64(1))
            run = np.cumsum(np.r_[0, common < LENGTH - o])
            ok = np.flatnonzero((l_ >= o) & (r_ >= LENGTH - o))
            if not len(ok):
                continue
            k = np.lexsort((d[ok], prefix[ok], run[ok]))
            k = ok[k]
            new = np.r_[True, (run[k][1:] != run[k][:-1]) | (prefix[k][1:] != prefix[k][:-1])]
            at = np.flatnonzero(new)
            size = np.diff(np.r_[at, len(k)])
            low, high = d[k][at], np.maximum.reduceat(d[k], at)
            twice = (high > low) | np.logical_or.reduceat(many[k], at)
            # an entry of several documents has its smallest id here; the others of it are later anyway
            hit[k] |= np.repeat(twice, size).astype(np.uint32) << np.uint32(o)
            later[k] |= (np.repeat(low, size) < d[k]).astype(np.uint32) << np.uint32(o)
        h, l2 = np.empty_like(hit), np.empty_like(later)
        h[order], l2[order] = hit, later
        ends = np.cumsum([0, *(len(g[2]) for g in got)])
        return [B.pack(h[x:y], l2[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]

    schema = f"doc_id {kind}, n_words long, n_repeated long, n_removable long, spans array<struct<start:int,stop:int>>"

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_repeated", "n_removable", "spans"]
        t = B.in_order(left) if left.num_rows else left
        pair = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        if not left.num_rows:
            return pa.Table.from_arrays([left.column("doc_id"), *(pa.array([], pa.int64()) for _ in range(3)), pa.array([], pair)], names)
        s = Suffixes(t)
        rows = sorted(zip(right.column("dest").to_pylist(), right.column("payload").to_pylist(), strict=True))
        state = B.unpack(rows[0][1])[0]
        replies = [B.unpack(p) for d, p in rows if d >= 0]
        low, at, high, row, _, first, which = entries(s, state)
        hit = np.concatenate([r[0] for r in replies] or [np.zeros(0, np.uint32)])
        later = np.concatenate([r[1] for r in replies] or [np.zeros(0, np.uint32)])
        doc = s.ids[row]
        marks = np.zeros((2, len(s.h) + 1), np.int64)
        for o in range(LEFT + 1) if len(which) else ():
            bit = np.uint32(1 << o)
            yes = np.flatnonzero(hit[which] & bit)
            # the entry's own smallest id in this block counts as smaller too
            old = np.flatnonzero((hit[which] & bit) & ((later[which] & bit) | ((doc > doc[first][which]).astype(np.uint32) << np.uint32(o))))
            for m, i in ((0, yes), (1, old)):
                np.add.at(marks[m], at[i] - o, 1)
                np.add.at(marks[m], at[i] - o + LENGTH, -1)
        cover = np.cumsum(marks, axis=1)[:, :-1] > 0
        out = []
        for r in range(t.num_rows):
            u, v = s.first[r], s.first[r + 1]
            if cover[0, u:v].any():
                edge = np.flatnonzero(np.diff(np.r_[0, cover[0, u:v].astype(np.int8), 0]))
                out.append((r, int(v - u), int(cover[0, u:v].sum()), int(cover[1, u:v].sum()), [{"start": int(x), "stop": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)]))
        r, *rest = zip(*out, strict=True) if out else ((), (), (), (), ())
        ids = t.column("doc_id").take(pa.array(r, pa.int64()))
        return pa.Table.from_arrays([ids, *(pa.array(x, pa.int64()) for x in rest[:3]), pa.array(rest[3], pair)], names)

    keys = B.answer(dealt.groupBy("__block").applyInArrow(ask_keys, B.MESSAGES), count_keys, n)
    asked = dealt.groupBy("__block").cogroup(B.back(keys, n)).applyInArrow(ask_suffixes, B.MESSAGES)
    found = B.answer(asked, compare, n)
    return dealt.groupBy("__block").cogroup(B.back(found, n)).applyInArrow(finish, schema)
