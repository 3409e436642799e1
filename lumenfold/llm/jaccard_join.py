"""Exact Jaccard self-join of word shingles, as components of similar texts.

Texts with equal shingle sets form a class and are represented once. Classes are joined on the prefix of their sets in a
global rare-first order: |x| - ceil(t |x|) + 1 shingles, ordered by document frequency (counted over all rows in
2^SKETCH_BITS hash buckets and kept as a byte each, so the table has a fixed size; any order is exact, rarer first has fewer candidates).
Candidates pass the length filter and the positional filter where they meet, then a suffix filter (the classes' counts in
ranges of the hash space bound the overlap) before any set is built; the intersection is computed once per pair.

Links are needed only between components, so no list of a shingle is paired out: in every list the class that
has the shingle earliest (it has the fewest rare shingles, as the original of its copies has) is compared with the
others, per block and per shard and then once more over whole lists, and every class with the one of these that most
of its lists name. Connected components follow, and then all remaining pairs of one list that lie in different components pass the same filters and verification: no
link between different texts is lost, and a large group of copies costs a pair per member.

Null texts, texts without words and rows with a null id are linked with nothing (component: their own id). Rows with
equal ids count as one node; of such rows with different texts each is compared. Repeated rows each get their own result;
an empty table gives an empty one; ties of rarity are ordered by hash; other columns are not read, whatever their names.
Ids that aren't integers raise TypeError.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm import blocks as B
from lumenfold.llm.bloom import Bloom
from lumenfold.llm.common import by_piece, need_integers
from lumenfold.llm.tokens import fold, grams, mix, pieces, words
from lumenfold.plans.graph import connected_components
from lumenfold.plans.shared import materialize

SKETCH_BITS, SLICES, RANGES = 22, 64, 16
#: A list with more than LIST entries in several components is met in up to SPLITS tasks.
LIST, SPLITS = 256, 64


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's k-word shingles; fewer words are one shingle."""
    h, first, *_ = words(col, True)
    g = grams(h, k)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(g[a : b - k + 1]))
        else:
            out.append(mix(np.array([fold(h[a:b]) & 0xFFFFFFFFFFFFFFFF], np.uint64)) if b > a else np.zeros(0, np.uint64))
    return out


def frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """Rarity class of every hash bucket, in bytes: 8 log2(1 + document frequency)."""
    size = 1 << SKETCH_BITS

    def count(batches):
        total = np.zeros(size, np.uint32)
        for b in pieces(batches):
            sets = shingle_sets(b.column("text"), k)
            total += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size).astype(np.uint32)
        if total.any():
            for i, part in enumerate(np.split(total, SLICES)):
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([0], pa.int64()), pa.array([0], pa.int32()), pa.array([B.pack(B.narrow(part))], pa.binary())], B._NAMES)

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(size // SLICES, np.uint64)
        for x in t.column("payload"):
            total += B.unpack(x.as_py())[0]
        return B.messages([(t.column("dest")[0].as_py(), 0, 0, B.pack(B.narrow(total)))])

    out = np.zeros(size, np.uint32)
    for r in docs.select("text").mapInArrow(count, B.MESSAGES).groupBy("dest").applyInArrow(add, B.MESSAGES).collect():
        out[r["dest"] * (size // SLICES) : (r["dest"] + 1) * (size // SLICES)] = B.unpack(bytes(r["payload"]))[0]
    return np.minimum(255, np.round(8 * np.log2(1.0 + out))).astype(np.uint8)


def prefix(s: np.ndarray, df: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, rarest first."""
    n = len(s)
    take = n - (percent * n + 99) // 100 + 1
    f = df[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    if take < n // 2:
        near = np.flatnonzero(f <= np.partition(f, take - 1)[take - 1])
        s, f = s[near], f[near]
    return s[np.lexsort((s, f))[:take]]


def stars(token, cls, size, pos, percent: int):
    """Of entries sorted by (token, pos, cls): pairs with the first of each token that pass the filters, and list bounds."""
    new = np.r_[True, token[1:] != token[:-1]]
    start = np.flatnonzero(new)
    hub = np.repeat(start, np.diff(np.r_[start, len(token)]))
    other = np.flatnonzero(~new)
    h = hub[other]
    return h[ok := may_link(size[h], pos[h], size[other], pos[other], percent)], other[ok], start


def may_link(na, pa_, nb, pb, percent: int):
    """Length filter, and positional filter for a shingle that is the first the two sets share."""
    na, nb = na.astype(np.int64), nb.astype(np.int64)
    need = -(-percent * (na + nb) // (100 + percent))
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (np.minimum(na - pa_, nb - pb) >= need)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) and n_class (rows with the same set)."""
    need_integers(docs)
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    df = frequencies(docs, k)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2

    def sketch(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column("text"), k)
        prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        pre = [prefix(s, df, percent).tobytes() if len(s) else b"" for s in sets]
        hist = np.concatenate([np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=RANGES) for s in sets]).astype(np.int32)
        hist = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * RANGES, pa.int32()), pa.array(hist))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(pre, pa.binary()), hist], ["doc_id", "n", "print", "pre", "hist"])

    rows = materialize(docs.select("doc_id", "text").mapInArrow(by_piece(sketch), f"doc_id {kind}, n long, print binary, pre binary, hist array<int>"), "sets")
    known = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("print")
    classes = known.agg(F.min("doc_id").cast("long").alias("cls"), F.first("n").alias("n"), F.first("pre").alias("pre"))
    narrow = materialize(known.agg(F.min("doc_id").cast("long").alias("cls"), F.first("n").alias("n"), F.count("*").alias("n_class"), F.first("hist").alias("hist")), "classes")

    def entries(batches):
        task = 0
        held: list[pa.RecordBatch] = []
        waiting = 0
        for b in batches:
            held.append(b)
            waiting += b.nbytes
            if waiting > 16 << 20:
                yield from block(held)
                held, waiting = [], 0
                task += 1
        if held:
            yield from block(held)

    def block(held: list[pa.RecordBatch]):
        t = pa.Table.from_batches(held).combine_chunks()
        cls, n = t.column("cls").to_numpy(), t.column("n").to_numpy()
        pre = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("pre")]
        long = np.array([len(p) for p in pre])
        token, own = np.concatenate(pre), np.repeat(np.arange(len(pre)), long)
        pos = np.arange(len(token)) - np.repeat(np.cumsum(long) - long, long)
        o = np.lexsort((cls[own], pos, token))
        token, own, pos = token[o], own[o], pos[o]
        a, b, start = stars(token, own, n[own], pos, percent)
        count = np.diff(np.r_[start, len(token)])
        many = np.repeat(count > 1, count)
        many[start] = False  # the shard lists the first of each token
        out = [(-1, 0, 0, B.pack(cls[own[a]], cls[own[b]])), (-1, 0, 1, B.pack(token[many], cls[own[many]], n[own[many]], pos[many]))]
        order, bounds = B.by_shard(token[start], shards)
        for p in np.flatnonzero(np.diff(bounds)):
            i = start[order[bounds[p] : bounds[p + 1]]]
            used, local = np.unique(own[i], return_inverse=True)
            out.append((int(p), int(cls[own[i[0]]]), 0, B.pack(token[i], B.narrow(local), B.narrow(pos[i]), count[order[bounds[p] : bounds[p + 1]]] > 1, cls[used], n[used])))
        for m in B.messages(out).to_batches():
            yield m

    def meet(t: pa.Table) -> pa.Table:
        if t.column("dest")[0].as_py() < 0:
            return t
        got = [B.unpack(x.as_py()) for x in t.column("payload")]
        token = np.concatenate([g[0] for g in got])
        cls = np.concatenate([g[4][g[1]] for g in got])
        n = np.concatenate([g[5][g[1]] for g in got])
        pos = np.concatenate([g[2].astype(np.int64) for g in got])
        more = np.concatenate([g[3] for g in got])
        o = np.lexsort((cls, pos, token))
        token, cls, n, pos, more = token[o], cls[o], n[o], pos[o], more[o]
        a, b, start = stars(token, cls, n, pos, percent)
        count = np.diff(np.r_[start, len(token)])
        # a pair in no block's list too: it may be no class's best hub, and is then found only here
        listed = np.repeat((count > 1) | (np.add.reduceat(more.astype(np.int64), start) > 0), count)
        return B.messages([(-1, 0, 0, B.pack(cls[a], cls[b])), (-1, 0, 1, B.pack(token[listed], cls[listed], n[listed], pos[listed]))])

    sent = classes.select("cls", "n", "pre").mapInArrow(entries, B.MESSAGES)
    # what a block has already decided needs no shard: it goes on from where it is
    sent = materialize(sent, "entries")
    met = materialize(sent.where("dest >= 0").groupBy("dest").applyInArrow(meet, B.MESSAGES).union(sent.where("dest < 0")), "met")

    def pairs_of(batches):
        for b in batches:
            for x in b.column("payload"):
                u, v = B.unpack(x.as_py())
                both, n = np.unique(np.stack([u, v], axis=1), axis=0, return_counts=True) if len(u) else (np.zeros((0, 2), np.int64), u)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].astype(np.int64)), pa.array(both[:, 1].astype(np.int64)), pa.array(n.astype(np.int64))], ["hub", "cls", "n"])

    def lists_of(batches):
        for b in batches:
            for x in b.column("payload"):
                token, cls, n, pos = B.unpack(x.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(cls.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))], ["token", "cls", "n", "pos"])

    named_by = met.where("kind = 0").select("payload").mapInArrow(pairs_of, "hub long, cls long, n long").where("hub <> cls").groupBy("hub", "cls").agg(F.sum("n").alias("n"))
    best = named_by.groupBy("cls").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    pairs = materialize(best.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct(), "pairs")
    links = materialize(verify(docs, pairs, narrow, k, percent), "links")
    found = connected_components(links)
    lists = distinct_lists(materialize(met.where("kind = 1").select("payload").mapInArrow(lists_of, "token long, cls long, n int, pos int"), "lists"))
    need = lambda a, b: F.expr(f"({percent} * cast({a}.n + {b}.n as long) + {99 + percent}) div {100 + percent}")
    passes = lambda a, b: F.expr(f"100L * least({a}.n, {b}.n) >= {percent}L * greatest({a}.n, {b}.n)") & (F.expr(f"least({a}.n - {a}.pos, {b}.n - {b}.pos)") >= need(a, b))
    # once more with the earliest of whole lists, where a list is still in several components
    open_ = unsettled(lists, found)
    first = open_.groupBy("token").agg(F.min_by(F.struct("cls", "n", "pos", "comp"), F.struct("pos", "cls")).alias("hub"))
    named_by = open_.alias("x").join(first, "token").where((F.col("x.comp") != F.col("hub.comp")) & passes("x", "hub")).groupBy(F.col("x.cls").alias("cls"), F.col("hub.cls").alias("hub")).agg(F.count("*").alias("n"))
    best = named_by.groupBy("cls").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    more = best.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = materialize(more, "pairs")
    if not more.isEmpty():
        pairs = pairs.union(more)
        links = links.union(materialize(verify(docs, more, narrow, k, percent), "links"))
        found = connected_components(links)
        open_ = unsettled(lists, found)
    # what is left: pairs of one list in different components
    sizes = open_.groupBy("token", "comp").agg(F.count("*").alias("c")).groupBy("token")
    largest = sizes.agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.expr(f"cast(least({SPLITS}, 1 + sum(c) div {LIST}) as int)").alias("splits"))
    marked = open_.join(largest, "token").select("*", (F.col("comp") == F.col("top")).alias("big"))
    # a long list is met in several tasks: one side is dealt, the other repeated
    x = marked.where("NOT big").withColumn("part", F.expr("cast(pmod(xxhash64(cls), splits) as int)")).alias("x")
    y = marked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).alias("y")
    rest = (
        x.join(y, F.expr("x.token = y.token AND x.part = y.part AND x.comp <> y.comp AND (y.big OR x.cls < y.cls)") & passes("x", "y"))
        .select(F.expr("least(x.cls, y.cls)").alias("a"), F.expr("greatest(x.cls, y.cls)").alias("b"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    rest = materialize(rest, "rest")
    if not rest.isEmpty():
        more = materialize(verify(docs, rest, narrow, k, percent), "links")
        if not more.isEmpty():
            found = connected_components(links.union(more))
    named = narrow.select("print", "cls", "n_class").join(found.withColumnRenamed("node", "cls"), "cls", "left").select("print", "n_class", F.coalesce("component", "cls").alias("component"))
    return rows.join(named, "print", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).cast(kind).alias("component_id"), F.coalesce("n_class", F.lit(1)).alias("n_class"))


def distinct_lists(lists: DataFrame) -> DataFrame:
    """Of shingles whose lists hold the same classes, the one that comes first in the global order: the first shingle that
    a pair shares is always among them, and copies that share hundreds of rare shingles leave one list."""
    dealt = lists.repartition("token")
    marks = dealt.groupBy("token").agg(F.bit_xor(F.xxhash64("cls")).alias("p"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("q"), F.count("*").alias("c"), F.min("pos").alias("first"))
    keep = marks.groupBy("p", "q", "c").agg(F.min_by("token", F.struct("first", "token")).alias("token")).select("token")
    return materialize(dealt.join(keep, "token", "left_semi"), "lists")


def unsettled(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Entries, with their components, of shingles whose lists are in more than one."""
    d = lists.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("token", "cls", "n", "pos", F.coalesce("component", "cls").alias("comp"))
    split = d.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    return materialize(d.join(split, "token", "left_semi"), "open")


def verify(docs: DataFrame, pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose sets are similar enough. The suffix filter comes first, on the classes' counts by range
    of the hash space; only rows that a Bloom filter of the remaining ids lets through have their sets built."""
    need = lambda a, b: F.expr(f"({percent} * cast({a} + {b} as long) + {99 + percent}) div {100 + percent}")
    one, two = (classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("hist").alias(f"h{c}")) for c in "ab")
    bound = F.expr("aggregate(zip_with(ha, hb, (p, q) -> least(p, q)), 0, (t, z) -> t + z)")
    pairs = materialize(pairs.join(one, "a").join(two, "b").where(bound >= need("na", "nb")).select("a", "b"), "candidates")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(F.xxhash64("id").alias("h"))
    bloom = Bloom(ids, "h", 2 * pairs.count())

    def sets(b: pa.RecordBatch) -> pa.RecordBatch | None:
        hit = bloom.find(b.column("h").to_numpy().view(np.uint64))
        if not len(hit):
            return None
        b = b.take(pa.array(hit))
        own = shingle_sets(b.column("text"), k)
        size = np.cumsum([0, *map(len, own)])
        return pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(np.concatenate(own).view(np.int64)))], ["id", "s"])

    whole = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("doc_id").cast("long")).alias("h"), "text")
    whole = materialize(whole.mapInArrow(by_piece(sets), "id long, s array<long>"), "whole")
    both = pairs.join(whole.toDF("a", "sa"), "a").join(whole.toDF("b", "sb"), "b")
    return both.where(F.size(F.array_intersect("sa", "sb")) >= need("size(sa)", "size(sb)")).select("a", "b").distinct()
