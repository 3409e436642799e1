"""Language-model scoring with a probabilistic suffix tree over words.

Every word is a symbol of its own, and every sequence of up to DEPTH words that the training documents hold at least
MIN_COUNT times is a candidate context, so the tree grows with the corpus. A context is retained if its next-symbol
distribution diverges from its longest retained suffix's: count x KL divergence must pay for its k followers,
k/2 ln(count). Its distribution is smoothed by that suffix's, (n + WEIGHT p) / (N + WEIGHT), down to the words' own,
(c + 0.5) / (N + 0.5 (V + 1)). Each token is scored in its longest suffix state, within its document.

No machine holds the tree. Blocks of text send their distinct words to the words' shards and get numbers and corpus counts
back (first round). A context's suffixes share its last word, so that word's shard can build the whole subtree: a block
sends each distinct (context, next word) of its tokens there and gets one probability back (second round). Contexts with
HOT occurrences or more would make a shard uneven. They take the same test in rounds of their own before: their (context,
next word) pairs are dealt by both, each shard sums what its pairs gain, a shard of contexts adds these sums up and tells
the blocks which contexts are retained; what is below them is dealt by one word more. So HOT decides where a context is
counted and nothing else. A token's final probability is a 16-bit logarithm, in steps of 1 / STEPS of a bit, an error of half a
step (0.00015 in log10) a token at most; a word's own follows from the level of its count, as exactly.

Counts cover all training documents and don't depend on how the table is split. Null and empty texts consist of the end
token alone; null ids count as the empty text in crc32. Repeated rows each count and each get their own result. Without
training tokens N = V = 0 and all scores are those of the smoothed empty counts; an empty table gives an empty result; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from lumenfold.llm import blocks as B
from lumenfold.llm.common import remainder
from lumenfold.llm.tokens import MUL, mix, pieces, words
from lumenfold.plans.shared import Buckets

MIN_COUNT, DEPTH, WEIGHT = 2, 3, 50.0
#: Contexts with so many occurrences are counted in rounds of their own.
HOT = 1 << 19
STEPS = 1024
END = np.uint64(0x454E44)
PIECE = 8 << 20
#: Kinds of messages beside replies (0: words, 1 to DEPTH: hot pairs, then contexts): a block's tokens and ids, totals of a
#: round's shards (TOTALS - round), and questions, which go to a shard; a round's sums for its hot contexts (GAINS - round), and
#: replies that say which of these are retained (KEPT + round).
TOKENS, IDS, ASK, TOTALS, GAINS, KEPT = -1, -2, -3, -4, -16, 16


def level(count: np.ndarray) -> np.ndarray:
    """log2(count + 1/2) in steps, from 0 on."""
    return (np.round(np.log2(count + 0.5) * STEPS) + STEPS).astype(np.uint16)


def pack_logs(p: np.ndarray) -> np.ndarray:
    return np.round(-np.log2(p) * STEPS).astype(np.uint16)


def unpack_logs(q: np.ndarray) -> np.ndarray:
    return np.exp2(-q.astype(np.float64) / STEPS)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about PIECE bytes of text, across the ones that come in."""
    held, size = [], 0
    for b in pieces(batches, most=PIECE):
        if held and size + b.nbytes > PIECE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def split_blocks(parts: int):
    """mapInArrow function: a message per shard with the block's words, and two to itself with its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        block = ((task.partitionId() if task else 0) + 1) << 24
        for b in merged(batches):
            block += 1
            h, first, *_ = words(b.column("text"), True)
            size = np.diff(first) + 1
            seq = np.full(len(h) + b.num_rows, END, np.uint64)
            inner = np.ones(len(seq), bool)
            inner[np.cumsum(size) - 1] = False
            seq[inner] = h
            key, _, local = B.groups(seq)
            held = b.column("held_out").to_numpy(zero_copy_only=False)
            train = np.bincount(local, np.repeat(~held, size), len(key)).astype(np.int64)
            order, bounds = B.by_shard(key, parts)
            number = np.empty(len(key), np.int64)
            number[order] = np.arange(len(key))
            ids = pa.RecordBatch.from_arrays([b.column("doc_id")], ["doc_id"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, ids.schema) as w:
                w.write_batch(ids)
            out = [(-1, block, TOKENS, B.pack(B.narrow(number[local]), held, B.narrow(size))), (-1, block, IDS, sink.getvalue().to_pybytes())]
            for p in np.flatnonzero(np.diff(bounds)):
                i = order[bounds[p] : bounds[p + 1]]
                out.append((int(p), block, ASK, B.pack(key[i], B.narrow(train[i]))))
            yield from B.messages(out).to_batches()

    return run


def count_words(t: pa.Table, parts: int) -> pa.Table:
    """A shard: corpus count of every word asked for, in that order, a number for it as a context (from 1; smaller ones are
    more frequent, so they pack well) and one for it among the next words of its level; and the shard's totals."""
    dest = t.column("dest")[0].as_py()
    got = [B.unpack(x.as_py()) for x in t.column("payload")]
    key, _, back = B.groups(np.concatenate([g[0] for g in got]))
    n = np.bincount(back, np.concatenate([g[1] for g in got])).astype(np.int64)
    order = np.lexsort((key, -n))
    number = np.empty(len(key), np.int64)
    number[order] = np.arange(len(key)) * parts + dest + 1
    high = level(n[order])
    new = np.flatnonzero(np.r_[True, high[1:] != high[:-1]])
    among = np.empty(len(key), np.int64)
    among[order] = (np.arange(len(key)) - np.repeat(new, np.diff(np.r_[new, len(key)]))) * parts + dest
    out = [(dest, -1, TOTALS, B.pack(np.array([n.sum(), (n > 0).sum(), n.max()], np.int64)))]
    ends = np.cumsum([0, *(len(g[0]) for g in got)])
    for i, s in enumerate(t.column("src").to_pylist()):
        mine = back[ends[i] : ends[i + 1]]
        out.append((dest, s, 0, B.pack(*(B.narrow(x[mine]) for x in (n, number, among)))))
    return B.messages(out)


def pays(gain: np.ndarray, kinds: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The divergence test: whether contexts with so many occurrences gain enough for their followers."""
    return (total >= MIN_COUNT) & (gain > 0.5 * kinds * np.log(np.maximum(total, 1)))


def count_pairs(t: pa.Table, parts: int) -> pa.Table:
    """A shard of (hot context, next word) pairs: the probability if the context is retained, and the count where it is hot
    itself; and to the contexts' shards what their pairs here gain."""
    dest = t.column("dest")[0].as_py()
    kind = t.column("kind")[0].as_py()
    got = [B.unpack(x.as_py()) for x in t.column("payload")]
    total, q = np.concatenate([g[2] for g in got]).astype(np.float64), np.concatenate([g[3] for g in got])
    _, at, back = B.groups(np.concatenate([g[0] for g in got]))
    count = np.bincount(back, np.concatenate([g[1] for g in got])).astype(np.int64)
    n, parent = count[back], unpack_logs(q)
    new = (-np.log2((n + WEIGHT * parent) / (total + WEIGHT)) * STEPS).astype(np.float32)
    most = np.array([n.max()], np.int64)
    n = np.where(n >= HOT, n, 0)
    ends = np.cumsum([0, *(len(g[0]) for g in got)])
    out = [(dest, s, kind, B.pack(new[a:b], B.narrow(n[a:b]))) for s, a, b in zip(t.column("src").to_pylist(), ends[:-1], ends[1:], strict=True)]
    seen = np.flatnonzero(count > 0)
    pair, c = at[seen], count[seen]
    ctx, first, which = B.groups(np.concatenate([g[4] for g in got])[pair])
    gain = np.bincount(which, c * np.log(c / total[pair] / parent[pair]), len(ctx))
    kinds, whole = np.bincount(which, minlength=len(ctx)), total[pair][first].astype(np.int64)
    order, bounds = B.by_shard(ctx, parts)
    # sums lie in the buckets of the shards that they go to
    for p in np.flatnonzero(np.diff(bounds)):
        i = order[bounds[p] : bounds[p + 1]]
        out.append((int(p), -2 - int(p), GAINS - kind, B.pack(ctx[i], gain[i], B.narrow(kinds[i]), B.narrow(whole[i]))))
    return B.messages([(dest, -1, TOTALS - kind, B.pack(most)), *out])


def decide(depth: int):
    """A shard of hot contexts: which of those asked for are retained, by the sums of all shards of pairs."""

    def run(t: pa.Table) -> pa.Table:
        dest, rows = t.column("dest")[0].as_py(), [(s, B.unpack(x.as_py())) for s, x in zip(t.column("src").to_pylist(), t.column("payload"), strict=True)]
        sums = [g for s, g in rows if s < 0]
        ctx, first, which = B.groups(np.concatenate([g[0] for g in sums] or [np.zeros(0, np.uint64)]))
        add = lambda i: np.bincount(which, np.concatenate([g[i] for g in sums]), len(ctx)) if sums else np.zeros(0)
        total = np.concatenate([g[3] for g in sums]).astype(np.int64)[first] if sums else np.zeros(0)
        kept = ctx[pays(add(1), add(2), total)]
        return B.messages([(dest, s, KEPT + depth, B.pack(np.isin(g[0], kept).astype(np.uint8))) for s, g in rows if s >= 0])

    return run


def subtree(before: list[np.ndarray], word: np.ndarray, n: np.ndarray, done: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probability of each entry's next word in its longest suffix state. before: the words before it, nearest first, 0
    where there is none; done: how many of them p takes into account already (contexts of other shards)."""
    most, _, word = B.groups(word)
    most = len(most)
    ctx = np.zeros(len(word), np.int64)
    for depth, w in enumerate(before, 1):
        several, _, w = B.groups(w)
        several, _, ctx = B.groups(ctx * len(several) + w)
        use = np.flatnonzero((before[depth - 1] > 0) & (done < depth))
        if not len(use):
            continue
        _, at, pair = B.groups(ctx[use] * most + word[use])
        own, parent = ctx[use][at], p[use][at]
        count = np.bincount(pair, n[use])
        total = np.bincount(own, count, len(several))
        seen = count > 0
        gain = np.bincount(own[seen], count[seen] * np.log(count[seen] / total[own[seen]] / parent[seen]), len(total))
        kinds = np.bincount(own[seen], minlength=len(total))
        kept = pays(gain, kinds, total)
        p = p.copy()
        p[use] = np.where(kept[own], (count + WEIGHT * parent) / (total[own] + WEIGHT), parent)[pair]
    return p


def grow(t: pa.Table, offset: int) -> pa.Table:
    """A shard of contexts: one probability for every entry, in the order asked."""
    dest = t.column("dest")[0].as_py()
    got = [B.unpack(x.as_py()) for x in t.column("payload")]
    last = np.concatenate([np.repeat(g[0], g[1]) for g in got]).astype(np.int64)
    rest = [np.concatenate([g[i] for g in got]).astype(np.int64) for i in range(2, DEPTH + 4)]
    high, among, n = rest[DEPTH - 1 :]
    # what hot contexts have settled already, where there are any
    done = np.concatenate([g[-2] if len(g) > DEPTH + 4 else np.zeros(len(g[2]), np.uint8) for g in got])
    q = np.concatenate([g[-1] if len(g) > DEPTH + 4 else (offset - g[DEPTH + 1].astype(np.int64)) for g in got])
    q = pack_logs(subtree([last, *rest[: DEPTH - 1]], high << 44 | among, n, done, unpack_logs(q)))
    ends = np.cumsum([0, *(len(g[2]) for g in got)])
    return B.messages([(dest, s, DEPTH + 1 + k, B.pack(q[a:b])) for s, k, a, b in zip(t.column("src").to_pylist(), t.column("kind").to_pylist(), ends[:-1], ends[1:], strict=True)])


class Block:
    """A block's tokens, from its own messages and all replies so far (kind 0: words, 1 to DEPTH: hot pairs, KEPT and more: hot
    contexts, DEPTH + 1 and DEPTH + 2: contexts)."""

    def __init__(self, left: pa.Table, right: pa.Table | None, parts: int, tokens: int, distinct: int, rounds: int):
        own, replies = {}, {}
        for t in (left, right) if right is not None else (left,):
            for k, d, x in zip(t.column("kind").to_pylist(), t.column("dest").to_pylist(), t.column("payload"), strict=True):
                if k < 0:
                    own[k] = x.as_py()
                else:
                    replies.setdefault(k, []).append((d, x))
        self.ids = pa.ipc.open_stream(own[IDS]).read_all().column(0).combine_chunks()
        loc, held, size = B.unpack(own[TOKENS])
        self.held, self.size, self.parts = held.astype(bool), size.astype(np.int64), parts
        answer = lambda k: [(d, B.unpack(x.as_py())) for d, x in sorted(replies.get(k, []), key=lambda r: r[0])]
        got = answer(0)
        # words of the block in the order asked, which is by shard
        self.number, self.among = (np.concatenate([g[i] for _, g in got]).astype(np.int64) for i in (1, 2))
        count = np.concatenate([g[0] for _, g in got]).astype(np.int64)
        self.high = level(count)
        self.shard = np.repeat([d for d, _ in got], [len(g[0]) for _, g in got])
        base = (count + 0.5) / (tokens + 0.5 * (distinct + 1))
        self.loc = loc = loc.astype(np.int64)
        n = len(loc)
        self.count, self.base = count[loc], base[loc]
        self.q = (root(tokens, distinct) - self.high.astype(np.int64)[loc]).astype(np.float64)
        place = np.arange(n) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.train = np.repeat(~self.held, self.size)
        # words before each token, nearest first, as number in the block + 1; a word that can't be in a context ends it
        self.before = []
        ok, may = np.ones(n, bool), self.count >= MIN_COUNT
        for d in range(1, DEPTH + 1):
            w, known = np.zeros(n, np.int64), np.zeros(n, bool)
            w[d:], known[d:] = loc[: max(0, n - d)] + 1, may[: max(0, n - d)]
            ok = ok & (place >= d) & known
            self.before.append(np.where(ok, w, 0))
        # occurrences of the context of each depth, as far as they are HOT
        self.done = np.zeros(n, np.int8)
        times = np.zeros(n, np.int64)
        times[1:] = self.count[:-1]
        times[(self.before[0] == 0) | (times < HOT)] = 0
        ctx = np.zeros(n, np.uint64)
        self.pairs = self.hot = None
        for d in range(1, rounds + 1):
            hot = np.flatnonzero(times > 0)
            ctx[hot] = mix(ctx[hot] * MUL + self.number[self.before[d - 1][hot] - 1].astype(np.uint64) + np.uint64(d))
            key, at, back = B.groups(mix(ctx[hot] * MUL + self.number[loc[hot]].astype(np.uint64)))
            order, bounds = B.by_shard(key, parts)
            if d not in replies and len(key):
                self.pairs = (d, key[order], np.bincount(back, self.train[hot], len(key)).astype(np.int64)[order], times[hot][at][order], self.q[hot][at][order].astype(np.float32), ctx[hot][at][order], bounds)
                return
            often = np.zeros(len(key), np.int64)
            if len(key):
                got = answer(d)
                q = np.empty(len(key))
                q[order], often[order] = np.concatenate([g[0] for _, g in got]), np.concatenate([g[1] for _, g in got])
                own, _, which = B.groups(ctx[hot])
                order, bounds = B.by_shard(own, parts)
                if KEPT + d not in replies:
                    self.hot = (own[order], bounds)
                    return
                kept = np.empty(len(own), bool)
                kept[order] = np.concatenate([g[0] for _, g in answer(KEPT + d)]) > 0
                self.q[hot] = np.where(kept[which], q[back], self.q[hot])
                self.done[hot] = d
            # the next token's context is this one's and its word
            times = np.zeros(n + 1, np.int64)
            times[hot + 1] = often[back]
            times = times[:n]
            ctx = self._context(np.flatnonzero(times), d + 1, n)
            if d < DEPTH:
                times[self.before[d] == 0] = 0

        longer = np.stack(self.before)[np.minimum(self.done, DEPTH - 1), np.arange(n)]
        open_ = np.flatnonzero((longer > 0) & (self.done < DEPTH))
        hot = self.done[open_] > 0
        self.plain, self.rest = open_[~hot], open_[hot]
        for kind, at in ((DEPTH + 1, self.plain), (DEPTH + 2, self.rest)):
            if kind in replies:
                pick, which, order, _ = self._entries(at, kind == DEPTH + 2)
                q = np.empty(len(pick), np.int64)
                q[order] = np.concatenate([g[0] for _, g in answer(kind)])
                self.q[at] = q[which]

    def _context(self, at: np.ndarray, depth: int, n: int) -> np.ndarray:
        """Hash of the depth - 1 words before each of some tokens, as the rounds of hot contexts continue it."""
        out = np.zeros(n, np.uint64)
        h = np.zeros(len(at), np.uint64)
        for d in range(1, depth):
            h = mix(h * MUL + self.number[self.before[d - 1][at] - 1].astype(np.uint64) + np.uint64(d))
        out[at] = h
        return out

    def _entries(self, at: np.ndarray, hot: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(a token of each distinct entry, which one every token has, order in which they are sent, shards in that order)."""
        _, _, key = B.groups(self.loc[at])
        for w in reversed(self.before):
            distinct, first, key = B.groups(w[at] * (int(key.max(initial=0)) + 1) + key)
        pick = at[first]
        if not hot:  # by the last word, so already by its shard
            return pick, key, np.arange(len(pick)), self.shard[self.before[0][pick] - 1]
        route = np.zeros(len(pick), np.uint64)
        whole = np.zeros(len(pick), np.uint64)
        for d in range(DEPTH):
            w = self.before[d][pick]
            whole = mix(whole * MUL + np.where(w > 0, self.number[w - 1], 0).astype(np.uint64) + np.uint64(d + 1))
            route = np.where(d <= self.done[pick], whole, route)
        shard = B.shard_of(route, self.parts).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return pick, key, order, shard[order]

    def ask_pairs(self, block: int) -> pa.Table:
        if self.pairs is None:
            return B.messages([])
        d, key, n, times, q, ctx, bounds = self.pairs
        return B.messages([(int(p), block, d, B.pack(key[i], B.narrow(n[i]), B.narrow(times[i]), q[i], ctx[i])) for p in np.flatnonzero(np.diff(bounds)) for i in [slice(bounds[p], bounds[p + 1])]])

    def ask_kept(self, block: int) -> pa.Table:
        if self.hot is None:
            return B.messages([])
        ctx, bounds = self.hot
        return B.messages([(int(p), block, ASK, B.pack(ctx[bounds[p] : bounds[p + 1]])) for p in np.flatnonzero(np.diff(bounds))])

    def ask_contexts(self, block: int) -> pa.Table:
        out = []
        for kind, tokens in ((0, self.plain), (1, self.rest)):
            pick, which, order, shard = self._entries(tokens, kind == 1)
            n = np.bincount(which, self.train[tokens], len(pick)).astype(np.int64)[order]
            pick = pick[order]
            cut = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)] if len(shard) else [0]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                i = pick[a:b]
                last = self.before[0][i]
                new = np.flatnonzero(np.r_[True, last[1:] != last[:-1]])
                number = lambda w: B.narrow(np.where(w > 0, self.number[w - 1], 0))
                word = self.loc[i]
                more = (self.done[i].astype(np.uint8), self.q[i].astype(np.float32)) if kind else ()
                out.append((int(shard[a]), block, kind, B.pack(number(last[new]), B.narrow(np.diff(np.r_[new, len(last)])), *(number(w[i]) for w in self.before[1:]), self.high[word], B.narrow(self.among[word]), B.narrow(n[a:b]), *more)))
        return B.messages(out)


def root(tokens: int, distinct: int) -> int:
    """In steps: what a word's level is taken from to get its own probability's logarithm."""
    return round(float(np.log2(tokens + 0.5 * (distinct + 1))) * STEPS) + STEPS


def score(docs: DataFrame, held: int = 1, of: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns from rows whose
    crc32(doc_id) modulo `of` isn't `held`."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    parts = B.block_count(docs, PIECE)
    own = docs.select("doc_id", (remainder("doc_id", of) == held).alias("held_out"), "text")
    # blocks and the replies to them lie in buckets by block, so that every round finds them where they are
    blocks = Buckets(spark, "lm", "src", parts)
    blocks.add(own.mapInArrow(split_blocks(parts), B.MESSAGES))
    asked = blocks.read().where(f"kind = {ASK}")
    blocks.add(B.shards(asked, parts).applyInArrow(lambda t: count_words(t, parts), B.MESSAGES), deal=True)

    def totals(kind: int) -> list[np.ndarray]:
        """A row a shard."""
        return [B.unpack(bytes(r["payload"]))[0] for r in blocks.read().where(f"kind = {kind}").select("payload").collect()]

    sums = totals(TOTALS)
    tokens, distinct, often = int(sum(s[0] for s in sums)), int(sum(s[1] for s in sums)), int(max((s[2] for s in sums), default=0))
    offset = root(tokens, distinct)

    def state() -> DataFrame:
        return blocks.read().where(f"kind > {TOTALS} AND src >= 0")

    def asks(f, rounds: int, others: DataFrame | None = None) -> GroupedData:
        run = lambda t: f(Block(t, None, parts, tokens, distinct, rounds), t.column("src")[0].as_py())
        sent = state().groupBy("src").applyInArrow(run, B.MESSAGES)
        return B.shards(sent if others is None else sent.union(others), parts)

    rounds = 0
    while often >= HOT and rounds < DEPTH:
        rounds += 1
        blocks.add(asks(Block.ask_pairs, rounds).applyInArrow(lambda t: count_pairs(t, parts), B.MESSAGES), deal=True)
        gains = blocks.read().where(f"kind = {GAINS - rounds}").select("dest", "src", "kind", "payload")
        blocks.add(asks(Block.ask_kept, rounds, gains).applyInArrow(decide(rounds), B.MESSAGES), deal=True)
        often = max((int(s[0]) for s in totals(TOTALS - rounds)), default=0)
    replies = asks(Block.ask_contexts, rounds).applyInArrow(lambda t: grow(t, offset), B.MESSAGES)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def final(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left, right, parts, tokens, distinct, rounds)
        first = np.cumsum(b.size) - b.size
        add = lambda v: np.add.reduceat(v, first)
        return pa.Table.from_arrays(
            [b.ids, pa.array(b.held), pa.array(b.size), pa.array(add((b.count > 0).astype(np.int64))), pa.array(np.full(len(b.size), tokens)), pa.array(add(np.log10(b.base))), pa.array(add(np.round(b.q)) * (-np.log10(2) / STEPS))],
            names,
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return state().groupBy("src").cogroup(replies.groupBy("src")).applyInArrow(final, schema)
