"""Benchmark decontamination by spaced-seed hashing.

A seed hashes the words at the kept positions of a fixed mask and ignores the others, so a replaced word leaves many
seeds intact. Seeds of the benchmark and of the documents meet in one equi-join; documents first test their seeds against
a Bloom filter of the benchmark's seeds (at most MAX_BITS bits, so its size is bounded), and only those with a hit go on.
Every (document, item, shift) found is verified once, around the hit: along the shift, matching words count +1 and others
-1.5, and the best run must hold enough words of the item.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. Items with fewer words than a mask have masks of their own length, one
for each position that it ignores, so one replaced word is tolerated there as well. Items of fewer than MIN_WORDS words are
everyday phrases inside other texts: they match only a document that consists of exactly these words. Null and empty texts,
on either side, match nothing; repeated rows each get their own result; repeated items count once; an empty benchmark leaves
all documents clean; other columns are neither read nor changed, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.bloom import Bloom
from lumenfold.llm.common import by_piece, free_name
from lumenfold.llm.tokens import MUL, inside, mix, words
from lumenfold.plans.shared import materialize

#: 1: compared, 0: ignored.
MASKS = ("111010011", "110110101", "101101011")
#: Shorter items match whole documents only.
MIN_WORDS = 5
#: A run needs so many matching words, or so large a part of a shorter item.
NEED, PART = 12, 0.8
MISS = 1.5


def seeds(h: np.ndarray, first: np.ndarray, mask: str) -> np.ndarray:
    """Seed of the mask at every word, for words whose whole span lies in one row; others are undefined (see inside())."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = np.full(n, np.uint64(int(mask, 2) * 2654435761 + len(mask)))
    for j, c in enumerate(mask):
        if c == "1":
            s = s * MUL + h[j : j + n]
    return mix(s)


def short_masks(n: int) -> list[str]:
    """Masks for items of n words, fewer than those of MASKS: one for each ignored position, or none ignored."""
    return ["1" * i + "0" + "1" * (n - i - 1) for i in range(n)] if n >= MIN_WORDS else ["1" * n]


ALL_MASKS = [*MASKS, *(m for n in range(1, min(map(len, MASKS))) for m in short_masks(n))]


def item_seeds(items: DataFrame) -> DataFrame:
    """item_id, item_words, and the seeds, places and masks' places in all_masks() of every benchmark item with words."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch | None:
        h, first, *_ = words(b.column("text"), True)
        out = []
        for r in range(b.num_rows):
            own = h[first[r] : first[r + 1]]
            if len(own):
                masks = [m for m in MASKS if len(m) <= len(own)] or short_masks(len(own))
                got = [(int(s), p, ALL_MASKS.index(m)) for m in masks for p, s in enumerate(seeds(own, None, m).view(np.int64))]
                out.append((r, own.view(np.int64).tolist(), *map(list, zip(*got, strict=True))))
        if not out:
            return None
        r, w, s, p, k = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(r)), pa.array(w, pa.list_(pa.int64())), pa.array(s, pa.list_(pa.int64())), pa.array(p, pa.list_(pa.int32())), pa.array(k, pa.list_(pa.int32()))], ["item_id", "item_words", "seeds", "at", "mask"])

    return items.select("item_id", "text").mapInArrow(by_piece(run), f"item_id {dict(items.dtypes)['item_id']}, item_words array<long>, seeds array<long>, at array<int>, mask array<int>")


def best_run(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(matching words, first word in the document, end) of the best-scoring run along doc[i + shift] = item[i]."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    if b <= a:
        return 0, 0, 0
    same = doc[a + shift : b + shift] == item[a:b]
    total = np.concatenate([[0], np.cumsum(np.where(same, 1.0, -MISS))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[: end + 1] == low[end])[-1]) if end else 0
    return int(same[start:end].sum()), a + shift + start, a + shift + end


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words (of the item), n_match, doc_start, doc_end for every contaminated row and item; also
    the row's key (xxhash64 of id and text), with which a caller can remove it."""
    bench = materialize(item_seeds(items), "items")
    n_seeds = bench.agg(F.sum(F.size("seeds"))).first()[0] or 0
    # at most as many rows as there are masks
    masks = [ALL_MASKS[r[0]] for r in bench.select(F.explode("mask").alias("m")).distinct().sort("m").collect()]
    bloom = Bloom(bench.select(F.explode("seeds").alias("s")), "s", n_seeds)

    def hits(b: pa.RecordBatch) -> pa.RecordBatch | None:
        h, first, *_ = words(b.column("text"), True)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for m in masks:
            s = seeds(h, first, m)
            maybe = bloom.find(s)
            if len(maybe):
                maybe = maybe[inside(first, len(h), len(m))[maybe]]
                if len(m) < MIN_WORDS:  # the whole document
                    row = np.searchsorted(first, maybe, "right") - 1
                    maybe = maybe[first[row + 1] - first[row] == len(m)]
                found.append((maybe, s[maybe]))
        at = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        if not len(at):
            return None
        s = np.concatenate([f[1] for f in found]).view(np.int64)
        row = np.searchsorted(first, at, "right") - 1
        o = np.argsort(row, kind="stable")
        at, s, row = at[o], s[o], row[o]
        rows, begin = np.unique(row, return_index=True)
        to = np.append(begin, len(row))
        return pa.RecordBatch.from_arrays(
            [
                b.column("doc_id").take(pa.array(rows)), b.column("row_key").take(pa.array(rows)),
                pa.array([h[first[r] : first[r + 1]].tobytes() for r in rows], pa.binary()),
                pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(s)),
                pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array((at - first[row]).astype(np.int32))),
            ],
            ["doc_id", "row_key", "words", "seeds", "at"],
        )

    kind = dict(docs.dtypes)["doc_id"]
    own = docs.select("doc_id", row_key().alias("row_key"), "text").where("text IS NOT NULL")
    near = materialize(own.mapInArrow(by_piece(hits), f"doc_id {kind}, row_key long, words binary, seeds array<long>, at array<int>"), "hits")
    # equal rows have equal results: they are searched once and counted
    near = near.groupBy("row_key", "doc_id").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("words", "seeds", "at")))
    near = materialize(near, "near")
    left = near.select("row_key", F.explode(F.arrays_zip("seeds", "at")).alias("h")).select("row_key", F.col("h.seeds").alias("seed"), F.col("h.at").alias("at"))
    right = bench.select("item_id", F.explode(F.arrays_zip("seeds", "at")).alias("h")).select("item_id", F.col("h.seeds").alias("seed"), F.col("h.at").alias("item_at"))
    pairs = left.join(right, "seed").select("row_key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    todo = pairs.join(bench.select("item_id", "item_words").distinct(), "item_id").join(near.select("row_key", "doc_id", "copies", "words"), "row_key")

    def verify(batches):
        for b in batches:
            out = []
            for i, (blob, item, shift) in enumerate(zip(b.column("words"), b.column("item_words"), b.column("shift").to_pylist(), strict=True)):
                w = item.values.to_numpy()
                m, start, end = best_run(np.frombuffer(blob.as_buffer(), np.int64), w, shift)
                if m >= min(NEED, int(np.ceil(PART * len(w)))):
                    out.append((i, len(w), m, start, end))
            if out:
                i, n, m, s, e = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(i)) for c in ("doc_id", "row_key", "item_id", "copies")] + [pa.array(x, pa.int64()) for x in (n, m, s, e)], ["doc_id", "row_key", "item_id", "copies", "n_words", "n_match", "doc_start", "doc_end"])

    kinds = dict(todo.dtypes)
    runs = todo.select("doc_id", "row_key", "item_id", "copies", "words", "item_words", "shift").mapInArrow(verify, f"doc_id {kind}, row_key long, item_id {kinds['item_id']}, copies long, n_words long, n_match long, doc_start long, doc_end long")
    best = F.max_by(F.struct("n_words", "n_match", "doc_start", "doc_end"), F.struct("n_match", -F.col("doc_start"), -F.col("doc_end"))).alias("b")
    found = runs.groupBy("row_key", "doc_id", "item_id").agg(best, F.first("copies").alias("copies"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.select("doc_id", "item_id", "b.*", "row_key", each.alias("copy")).drop("copy")


def row_key():
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs without a leak, all columns as they are."""
    name = free_name("bad", docs.columns)
    bad = find_leaks(docs, items).select(F.col("row_key").alias(name)).distinct()
    return docs.join(bad, row_key() == F.col(name), "left_anti")
