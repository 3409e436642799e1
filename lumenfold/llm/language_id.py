"""Language identification by error-correcting output codes over hashed character n-grams.

Every language has a codeword; one binary logistic classifier per bit sees byte 1- to 3-grams hashed to a fixed number of
buckets. Decoding sums the logistic loss of every bit, weighted by the bit's training accuracy, and takes the nearest
codeword; a small gap to the second flags ambiguity. Texts that are null or have no letter are "und" with score 0.

The classifiers are fitted on at most about SAMPLE labelled rows a language (chosen by a hash of the id, whole texts);
languages and their counts are taken from all labelled rows. Without any labelled row all predictions are "und".
Equal probabilities go to the alphabetically first language; repeated rows each get their own, equal result; an empty table
gives an empty one; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import by_piece, remainder
from lumenfold.llm.tokens import LOWER, raw

BUCKETS = 4096
SAMPLE = 600
STEPS, RATE, DECAY = 120, 20.0, 1e-5
_CLEAN = LOWER.copy()
_CLEAN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def gram_counts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x buckets, unit length, float32; whether a row has an ASCII letter)."""
    data, off = raw(col)
    d = _CLEAN[data].astype(np.uint32)
    n = len(d)
    idx = np.zeros((3, n), np.uint32)
    idx[0] = d * np.uint32(2654435761) >> np.uint32(20)
    if n > 1:
        idx[1, 1:] = ((d[1:] | d[:-1] << np.uint32(8)) + np.uint32(0x10000)) * np.uint32(2246822519) >> np.uint32(20)
    if n > 2:
        idx[2, 2:] = ((d[2:] | d[1:-1] << np.uint32(8) | d[:-2] << np.uint32(16)) + np.uint32(0x2000000)) * np.uint32(3266489917) >> np.uint32(20)
    out = np.zeros((len(off) - 1, BUCKETS), np.float32)
    letter = np.zeros(len(off) - 1, bool)
    ascii_letter = (d >= 97) & (d <= 122)
    for r, (a, b) in enumerate(zip(off[:-1], off[1:], strict=True)):
        for k in range(3):
            if b - a > k:
                out[r] += np.bincount(idx[k, a + k : b], minlength=BUCKETS)
        letter[r] = ascii_letter[a:b].any()
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9), letter


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k x bits of -1 and 1: all splits for up to 5 classes, else random columns that keep rows far apart."""
    if k <= 5:
        cols = [[1 if (m >> i) & 1 else -1 for i in range(k)] for m in range(1, 2 ** max(k - 1, 1))]
        return np.array(cols or [[1] * k], np.float32).T
    bits, rng, best, far = int(np.ceil(10 * np.log2(k))), np.random.default_rng(seed), None, -1
    for _ in range(200):
        m = rng.choice(np.array([-1, 1], np.float32), (k, bits))
        near = min((m[i] != m[j]).sum() for i in range(min(k, 64)) for j in range(i))
        if near > far:
            best, far = m, near
    return best


def fit(x: np.ndarray, y: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (buckets x bits), biases and bit weights, by accelerated gradient descent on balanced logistic loss."""
    t = code[y]
    share = np.bincount(y, minlength=len(code)).astype(np.float32)
    each = (1 / share[y] / (share > 0).sum())[:, None]
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(STEPS):
        aw, ab = w + 0.9 * vw, b + 0.9 * vb
        g = -t * each / (1 + np.exp(np.clip(t * (x @ aw + ab), -30, 30)))
        vw = 0.9 * vw - RATE * (x.T @ g + DECAY * aw)
        vb = 0.9 * vb - RATE * 0.1 * g.sum(axis=0)
        w, b = w + vw, b + vb
    right = ((t * (x @ w + b) > 0) * each).sum(axis=0)
    return w, b, np.maximum(right - 0.5, 0.01).astype(np.float32)


def decode(margins: np.ndarray, code: np.ndarray, trust: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, probability, gap to the second) by loss-weighted decoding."""
    loss = np.stack([(trust * np.logaddexp(0, -np.clip(margins * c, -30, 30))).sum(axis=1) for c in code], axis=1)
    p = np.exp(loss.min(axis=1, keepdims=True) - loss)
    p /= p.sum(axis=1, keepdims=True)
    top = np.sort(p, axis=1)
    return loss.argmin(axis=1), top[:, -1], top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)


def identify(docs: DataFrame, held: int = 2, of: int = 4, gap: float = 0.2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row; learns where crc32(doc_id) mod `of` is not `held`."""
    own = docs.select("doc_id", "text", "lang", (remainder("doc_id", of) == held).alias("held_out"))
    known = own.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    code = w = bias = trust = None
    if langs:
        # a share of each language by a hash of the id: no sort, and about SAMPLE rows each
        share = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(min(1.0, SAMPLE / sizes[k])))))
        picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(1 << 20) * share[F.col("lang")])

        def sparse(b: pa.RecordBatch) -> pa.RecordBatch:
            x, _ = gram_counts(b.column("text"))
            return pa.RecordBatch.from_arrays([b.column("lang"), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], ["lang", "x"])

        rows = picked.select("text", "lang").mapInArrow(by_piece(sparse), "lang string, x binary").collect()
        rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
        x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
        y = np.array([langs.index(r["lang"]) for r in rows])
        code = codewords(len(langs))
        w, bias, trust = fit(x, y, code)

    def predict(b: pa.RecordBatch) -> pa.RecordBatch:
        col = b.column("text")
        x, letter = gram_counts(col)
        for i in np.flatnonzero(~letter):
            letter[i] = any(c.isalpha() for c in col[i].as_py() or "")
        if code is None:
            pred, score, wide = np.zeros(len(x), int), np.zeros(len(x)), np.zeros(len(x))
            letter[:] = False
        else:
            pred, score, wide = decode(x @ w + bias, code, trust)
        names = [langs[p] if ok else "und" for p, ok in zip(pred, letter, strict=True)]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(np.where(letter, score, 0.0).astype(float)), pa.array(~letter | (wide < gap))],
            ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
        )

    return own.select("doc_id", "held_out", "text").mapInArrow(by_piece(predict, most=2 << 20), schema)
