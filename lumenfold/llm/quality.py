"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score is sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]), linear in the number of
features by the sum-of-squares identity. Hashed word frequencies have a fixed number of buckets, the structure
statistics are standardised on the sample, and the only metadata used are sizes of the text itself.

It is fitted on at most about SAMPLE labelled rows of each class (whole texts, chosen by a hash of the id). Without
labelled rows every score is the prior 0.5. Null and empty texts have a score too. Repeated rows each get their own, equal score; an id with several labels has
the largest; an empty table gives an empty one; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import by_piece, free_name, remainder
from lumenfold.llm.tokens import raw, words

BUCKETS, RANK = 1024, 8
SAMPLE = 1500
EPOCHS, RATE, DECAY, SEED = 30, 0.03, 1e-4, 11
CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "line": [10], "bang": [33], "pipe": [124], "mark": [35, 36, 37, 38, 42, 64], "stop": [44, 46, 59, 58, 63], "high": range(128, 256), "brace": [40, 41, 60, 62, 91, 93, 123, 125], "other": [34, 39, 43, 45, 47, 61, 92, 94, 95, 96, 126]}
STATS = len(CLASSES) + 9


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BUCKETS hashed word shares, rows x STATS structure statistics)."""
    h, first, start, end, data = words(col, True)
    rough, off = raw(col)
    n = len(off) - 1
    hashed = np.zeros((n, BUCKETS), np.float32)
    stats = np.zeros((n, STATS), np.float32)
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    size = end - start
    kinds = np.zeros(256, np.int64)
    for i, members in enumerate(CLASSES.values(), 1):
        kinds[list(members)] = i
    kind = kinds[rough]
    for r in range(n):
        a, b, u, v = off[r], off[r + 1], first[r], first[r + 1]
        chars, count = max(b - a, 1), v - u
        if count:
            own, uses = np.unique(h[u:v], return_counts=True)
            hashed[r] = np.sqrt(np.bincount(bucket[u:v], minlength=BUCKETS) / count)
            s = size[u:v]
            lines = rough[a:b].tobytes().split(b"\n")
            stats[r, len(CLASSES) :] = (len(own) / count, uses.max() / count, s.mean() / 10, s.std() / 10, (s > 15).mean(), 1 - len(set(lines)) / len(lines), (h[u + 1 : v] == h[u : v - 1]).sum() / count, np.log1p(count) / 10, len(own) / np.sqrt(count) / 20)
        stats[r, : len(CLASSES)] = np.sqrt(np.bincount(kind[a:b], minlength=len(CLASSES) + 1)[1:] / chars)
    return hashed, stats


def margins(x: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    return w0 + x @ w + 0.5 * ((x @ v) ** 2 - (x * x) @ (v * v)).sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss of mini-batches in a fixed random order."""
    rng = np.random.default_rng(SEED)
    p = [np.zeros(1, np.float32), np.zeros(x.shape[1], np.float32), (rng.standard_normal((x.shape[1], RANK)) * 0.02).astype(np.float32)]
    m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            step += 1
            b = x[at]
            xv = b @ p[2]
            z = p[0] + b @ p[1] + 0.5 * (xv**2 - (b * b) @ (p[2] * p[2])).sum(axis=1)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) / len(at)).astype(np.float32)
            grads = [g.sum(keepdims=True), b.T @ g + DECAY * p[1], b.T @ (g[:, None] * xv) - p[2] * ((b * b).T @ g)[:, None] + DECAY * p[2]]
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                s[i] = 0.999 * s[i] + 0.001 * d * d
                p[i] = p[i] - RATE * (0.5 if epoch > EPOCHS // 2 else 1) * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-6)
    return float(p[0][0]), p[1].astype(np.float32), p[2].astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, held: int = 0, of: int = 5) -> dict | None:
    """The model as arrays of fixed size; None without labelled rows of both classes."""
    y = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("y")).where(remainder("doc_id", of) != held)
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = F.create_map(*(F.lit(v) for k in sizes for v in (k, min(1.0, SAMPLE / sizes[k]))))
    picked = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(1 << 20) * share[F.col("y")])

    def pack(b: pa.RecordBatch) -> pa.RecordBatch:
        hashed, stats = features(b.column("text"))
        both = np.concatenate([hashed, stats], axis=1).astype(np.float16)
        return pa.RecordBatch.from_arrays([b.column("y"), pa.array([r.tobytes() for r in both], pa.binary())], ["y", "x"])

    # about 2 * SAMPLE narrow rows at most, by the sizes counted above
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "y").mapInArrow(by_piece(pack, most=2 << 20), "y int, x binary").collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["x"])))
    if not rows:
        return None
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    t = np.array([r["y"] for r in rows], np.float32)
    mean, std = x[:, BUCKETS:].mean(axis=0), x[:, BUCKETS:].std(axis=0) + 1e-3
    x[:, BUCKETS:] = np.clip((x[:, BUCKETS:] - mean) / std, -6, 6) / 3
    w0, w, v = fit(x, t)
    # the sample has a share of its own of each class; the prior of all labelled rows is put back
    w0 += np.log(sizes[1] / sizes[0]) - np.log(max(1.0, t.sum()) / max(1.0, (1 - t).sum()))
    return {"mean": mean, "std": std, "w0": float(w0), "w": w, "v": v}


def score(docs: DataFrame, model: dict | None, keep: list[str] | None = None, name: str = "__score") -> DataFrame:
    """The given columns of docs (default doc_id) and the score, under the given name."""
    keep = keep or ["doc_id"]
    text = free_name("text", keep)
    fields = {f.name: f for f in docs.schema.fields}

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        hashed, stats = features(b.column(text))
        if model is None:
            p = np.full(len(stats), 0.5)
        else:
            x = np.concatenate([hashed, np.clip((stats - model["mean"]) / model["std"], -6, 6) / 3], axis=1).astype(np.float32)
            p = 1 / (1 + np.exp(-np.clip(margins(x, model["w0"], model["w"], model["v"]).astype(np.float64), -40, 40)))
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(p, pa.float64())], [*keep, name])

    from pyspark.sql import types as T

    schema = T.StructType([*(T.StructField(c, fields[c].dataType, True) for c in keep), T.StructField(name, T.DoubleType())])
    return docs.select(*keep, F.col("text").alias(text)).mapInArrow(by_piece(run, text, 2 << 20), schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    s = score(docs, train(docs, labels))
    return s.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))
