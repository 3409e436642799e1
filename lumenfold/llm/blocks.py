"""Rounds of packed messages between blocks of documents and shards of a key space.

Documents are dealt to blocks of bounded size by a hash of their id and text. A block sends each shard one packed message with its
distinct keys, so a hot key costs one entry per block however many rows hold it; the shard answers every message in the
order of its entries, so answers carry no keys. Blocks are rebuilt from the same shuffle for the next round. A message is
sent only where there is an entry for it: there are at most blocks x shards of them, and never more than entries, so the
cost of a round stays in proportion to the text; BLOCK_BYTES is what decides how many entries share a message.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from lumenfold.llm.common import text_bytes

BLOCK_BYTES = 8 << 20
MESSAGES = "dest long, src long, kind int, payload binary"
_NAMES = ["dest", "src", "kind", "payload"]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays with a 7-byte head each (type, length), their bytes by significance (which packs better), compressed."""
    head = struct.pack("<B", len(arrays)) + b"".join(struct.pack("<3sI", a.dtype.str.encode(), len(a)) for a in arrays)
    planes = (a.tobytes() if a.itemsize == 1 else np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    body = head + b"".join(planes)
    return struct.pack("<I", len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    body = pa.decompress(blob[4:], struct.unpack("<I", blob[:4])[0], codec="zstd", asbytes=True)
    at, out = 1 + 7 * body[0], []
    for i in range(body[0]):
        name, size = struct.unpack_from("<3sI", body, 1 + 7 * i)
        kind = np.dtype(name.decode())
        a = np.frombuffer(body, np.uint8, size * kind.itemsize, at)
        out.append(a.view(kind) if kind.itemsize == 1 else np.ascontiguousarray(a.reshape(kind.itemsize, size).T).view(kind).ravel())
        at += a.nbytes
    return out


def groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, a position of each, which one every key is) of integers of 0 or more, sorted."""
    n = len(key)
    if not n:
        return key, np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = int(n).bit_length()
    if int(key.max()).bit_length() + bits <= 63:  # sorting one number is much faster than sorting positions
        s = np.sort(key.astype(np.int64) << bits | np.arange(n))
        order, s = s & ((1 << bits) - 1), s >> bits
    else:
        order = np.argsort(key)
        s = key[order]
    new = np.r_[True, s[1:] != s[:-1]]
    which = np.empty(n, np.int64)
    which[order] = np.cumsum(new) - 1
    return s[new], order[new], which


def narrow(a: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all values."""
    most = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32 if most < 1 << 32 else np.uint64)


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    d, s, k, p = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.Table.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(k, pa.int32()), pa.array(p, pa.binary())], _NAMES)


def block_count(docs: DataFrame, bytes_each: int = BLOCK_BYTES) -> int:
    """In proportion to the text, and no less than the session's shuffle partitions (so that Spark keeps the dealing)."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(docs) // bytes_each))


def blocks(docs: DataFrame, n: int) -> DataFrame:
    """docs with a column __block, dealt by it, a block a task; every round reads this one shuffle. Rows are dealt by id and text:
    those without an id, or with an id that many rows have, don't meet in one block."""
    return docs.withColumn("__block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")).repartitionById(n, "__block")


def shards(asked: DataFrame, n: int) -> GroupedData:
    """Messages by the shard they go to, a shard a task (hashing would put several into one)."""
    return asked.withColumn("dest", F.col("dest").cast("int")).repartitionById(n, "dest").groupBy("dest")


def back(answers: DataFrame, n: int) -> GroupedData:
    """Replies by the block that asked, beside the block itself."""
    return answers.withColumn("__block", F.col("src").cast("int")).repartitionById(n, "__block").groupBy("__block")


def shard_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)) % np.uint64(parts)


def in_order(t: pa.Table) -> pa.Table:
    """Rows by id, then text: the same order in every round."""
    return t.take(pc.sort_indices(t, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])).combine_chunks()


def by_shard(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order that groups keys by shard and sorts them within it, bounds of the shards)."""
    shard = shard_of(keys, parts)
    order = np.lexsort((keys, shard))
    return order, np.searchsorted(shard[order], np.arange(parts + 1))


def answer(asked: DataFrame, f, n: int) -> DataFrame:
    """Shards reply, in n tasks (as many as there are shards, so a task's messages don't grow with the table): f(list of
    payloads) -> list of replies, in the same order; kind < 0 goes on to its block as it is."""

    def run(t: pa.Table) -> pa.Table:
        dest = t.column("dest")[0].as_py()
        if dest < 0:
            return t.set_column(0, "dest", t.column("dest").cast(pa.int64()))
        t = t.take(pc.sort_indices(t, sort_keys=[("src", "ascending")]))
        got = f([x.as_py() for x in t.column("payload")])
        return messages([(dest, s, 1, r) for s, r in zip(t.column("src").to_pylist(), got, strict=True)])

    return shards(asked, n).applyInArrow(run, MESSAGES)
