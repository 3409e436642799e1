"""SentencePiece vocabularies: best-path encoding as a max-plus scan, and decoding.

The best path maximises the sum of piece scores over the lattice of all pieces, with byte pieces for characters outside
the vocabulary. Giant texts (over GIANT characters), and units without a cut of over CHUNK characters, are split into chunks
of CHUNK characters, wherever these end. Each chunk yields a transfer matrix from "characters that a piece of the chunk before
takes of it" to "characters that its last piece takes of the next one" (matrices); the matrices are combined by an associative
max-plus scan, which gives every chunk's entry values (prefix); and every chunk is traced back by itself from its exit state
(traces). Shorter texts fall apart at the places that no piece crosses; what lies between these, the units, is solved side by
side, once for each distinct unit. Both ways give the same path. Equal scores: the longer last piece wins, so ids don't depend
on where chunks end.

Spaces become U+2581 and one is put in front of non-empty texts; a U+2581 of the text itself is written as byte pieces,
so decoding returns every text unchanged. Null texts have no tokens and decode to null; empty ones have none and decode to
"". Repeated rows each get their own result, an empty table gives an empty one, and only the columns asked for are read,
whatever others are called. A giant text takes the scan's memory: about 40 bytes a character beside the text, and about 10
where it has a quarter of a million characters or more, as its chunks are longer then.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm.common import by_piece, free_name

SPACE = "▁"
#: Stands for a U+2581 of the text: a lone surrogate, which no valid text holds.
LITERAL = "\ud800"
CHUNK, CACHE = 64, 200_000
#: Texts of over GIANT characters are split into chunks; the scan takes about BATCH characters at once.
GIANT, BATCH = 1 << 16, 1 << 14
NEG = np.int64(-(1 << 50))


def load_pieces(path: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id of a .model file; kind is n(ormal), b(yte) or c(ontrol or unknown)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i), "b" if sp.is_byte(i) else "c" if sp.is_control(i) or sp.is_unknown(i) else "n") for i in range(sp.get_piece_size())]


class Codec:
    """Tables of one vocabulary; a fixed size, so it travels inside the task's closure."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.bytes_of: list[bytes] = []
        self.byte_id = np.zeros(256, np.int32)
        normal: dict[str, int] = {}
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "b":
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            else:
                self.bytes_of.append(p.replace(SPACE, " ").encode() if kind == "n" else b"")
                if kind == "n" and p:
                    normal.setdefault(p, i)
        scale = 1 if all(float(s).is_integer() for _, s, _ in pieces) else 1 << 20  # integers: sums don't depend on their order
        self.score = np.array([round(s * scale) for _, s, _ in pieces] + [0, 0], np.int64)
        self.score[-2] = min((self.score[i] for i in normal.values()), default=0) - 10  # index -2: a character as bytes
        self.longest = max(map(len, normal), default=1)
        # trie edges (node, character) -> node in an open-addressing table
        edges: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for p, i in normal.items():
            node = 0
            for c in p:
                node = edges.setdefault((node, ord(c)), len(edges) + 1)
            ends[node] = i
        self.ends = np.full(len(edges) + 1, -1, np.int32)
        self.ends[list(ends)] = list(ends.values())
        self.bits = max(4, int(np.ceil(np.log2(len(edges) + 1))) + 2)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.nexts = np.zeros(1 << self.bits, np.int32)
        for (node, c), nxt in edges.items():
            key = node << 21 | c
            at = self._slot(np.array([key], np.int64))[0]
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.nexts[at] = key, nxt
        inner = {c for p in normal if len(p) > 1 for c in p}
        self.cuts_at_space = all(SPACE not in p.lstrip(SPACE) for p in normal)
        self.newline_alone = "\n" not in inner
        stop = "\n" if self.newline_alone else ""
        self.units = re.compile(f"{SPACE}+[^{SPACE}{stop}]*|[^{SPACE}{stop}]+" + ("|\n" if stop else "")) if self.cuts_at_space else re.compile("(?s:.+)")
        self.cache: dict[str, tuple[bytes, int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _follow(self, key: np.ndarray) -> np.ndarray:
        at = self._slot(key)
        out = np.full(len(key), -1, np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            k = self.keys[at[open_]]
            hit = k == key[open_]
            out[open_[hit]] = self.nexts[at[open_[hit]]]
            open_ = open_[~hit & (k >= 0)]
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def lattice(self, chars: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """[length - 1, last position]: piece id, -1 none, -2 a character as bytes; pieces end before limit[start]."""
        ids = np.full((self.longest, len(chars)), -1, np.int32)
        act, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        for k in range(self.longest):
            ok = act + k < limit[act]
            act, node = act[ok], node[ok]
            if not len(act):
                break
            nxt = self._follow(node << 21 | chars[act + k].astype(np.int64))
            ok = nxt >= 0
            act, node = act[ok], nxt[ok]
            ids[k, act + k] = self.ends[node]
        ids[0, ids[0] == -1] = -2
        return ids

    def solve(self, units: list[str]) -> list[tuple[bytes, int]]:
        """(ids as little-endian int32 bytes, score) of each unit of at most CHUNK characters."""
        order = sorted(range(len(units)), key=lambda i: -len(units[i]))
        own = [units[i] for i in order]
        size = np.array([len(u) for u in own])
        chars = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(size) - size
        ids = self.lattice(chars, np.repeat(start + size, size))
        most, n = int(size.max()), len(own)
        value, back = np.full((most + 1, n), NEG), np.zeros((most + 1, n), np.int8)
        value[0] = 0
        for j in range(1, most + 1):
            m = int(np.searchsorted(-size, -j, "right"))
            end = start[:m] + j - 1
            best, length = np.full(m, NEG), np.zeros(m, np.int8)
            for k in range(min(j, self.longest), 0, -1):
                pid = ids[k - 1, end]
                s = value[j - k, :m] + self.score[pid]
                up = (pid != -1) & (s > best)
                best[up], length[up] = s[up], k
            value[j, :m], back[j, :m] = best, length
        at, who, unit_of, id_of, char_of = size.copy(), np.arange(n), [], [], []
        while len(who):
            k = back[at[who], who].astype(np.int64)
            end = start[who] + at[who] - 1
            unit_of.append(who), id_of.append(ids[k - 1, end]), char_of.append(chars[end])
            at[who] -= k
            who = who[at[who] > 0]
        flat, first = self._tokens(np.concatenate(unit_of)[::-1], np.concatenate(id_of)[::-1], np.concatenate(char_of)[::-1], n)
        blob, out = flat.tobytes(), [None] * n
        totals = value[size, np.arange(n)].tolist()
        for i, k in enumerate(order):
            out[k] = (blob[4 * first[i] : 4 * first[i + 1]], totals[i])
        return out

    def _tokens(self, unit: np.ndarray, ids: np.ndarray, chars: np.ndarray, n: int) -> tuple[np.ndarray, list[int]]:
        """Tokens in order by unit (a stable sort of what the trace gave), characters outside the vocabulary as bytes."""
        o = np.argsort(unit, kind="stable")
        unit, ids, chars = unit[o], ids[o].astype(np.int32), chars[o]
        odd = np.flatnonzero(ids == -2)
        if len(odd):
            enc = [(SPACE if c == ord(LITERAL) else chr(c)).encode("utf-8", "surrogatepass") for c in chars[odd].tolist()]
            reps = np.ones(len(ids), np.int64)
            reps[odd] = [len(x) for x in enc]
            at = np.cumsum(reps) - reps
            unit, ids = np.repeat(unit, reps), np.repeat(ids, reps)
            for p, x in zip(at[odd].tolist(), enc, strict=True):
                ids[p : p + len(x)] = self.byte_id[list(x)]
        return ids, np.searchsorted(unit, np.arange(n + 1)).tolist()

    def _chunks(self, chars: np.ndarray, a: int, b: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids by [length - 1, last position] and their gains, of the chunks a to b - 1 and one piece beyond."""
        part = chars[a * size : b * size + self.longest]
        ids = np.full((self.longest, (b - a) * size + self.longest), -1, np.int32)
        ids[:, : len(part)] = self.lattice(part, np.full(len(part), len(part)))
        ids[0, len(part) :] = -3  # padding behind the text is free
        gain = np.where(ids == -1, NEG, self.score[np.where(ids == -2, len(self.score) - 2, np.maximum(ids, 0))])
        gain[ids == -3] = 0
        return ids, gain

    def _advance(self, seed: np.ndarray, gain: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Chunks side by side; seed [chunks, states, width]: the value of each entry. Values and last lengths by position.
        A piece of the chunk before that ends at a position is longer than any that starts in this one, so it wins ties."""
        width = self.longest
        ends = np.arange(len(seed))[:, None] * size + np.arange(size + width)
        v = np.full((*seed.shape[:2], size + width), NEG)
        back = np.zeros(v.shape, np.int8)
        v[:, :, :width] = seed
        for j in range(1, size + width):
            best, length = v[:, :, j].copy(), np.zeros(v.shape[:2], np.int8)
            for k in range(min(j, width), max(0, j - size), -1):  # the piece starts in this chunk
                s = v[:, :, j - k] + gain[k - 1, ends[:, j - 1]][:, None]
                up = s > best
                np.copyto(best, s, where=up)
                length[up] = k
            v[:, :, j], back[:, :, j] = best, length
        return v, back

    def matrices(self, chars: np.ndarray, size: int) -> np.ndarray:
        """Transfer matrix [entry state, exit state] of every chunk: characters taken by the chunk before -> characters taken
        from the next one."""
        width, n = self.longest, -(-len(chars) // size)
        eye = np.where(np.eye(width, dtype=bool), 0, NEG)
        out = np.empty((n, width, width), np.int64)
        for a, b in self._batches(n, size):
            _, gain = self._chunks(chars, a, b, size)
            out[a:b] = self._advance(np.broadcast_to(eye, (b - a, width, width)), gain, size)[0][:, :, size:]
        return np.maximum(out, NEG)

    @staticmethod
    def prefix(matrix: np.ndarray) -> np.ndarray:
        """Max-plus products of the first 1, 2, ... matrices: an associative scan that doubles its reach each round."""
        n, width, d = len(matrix), matrix.shape[1], 1
        scan = matrix
        while d < n:
            new = scan.copy()
            for a in range(d, n, 2048):
                b = min(n, a + 2048)
                left, right = scan[a - d : b - d], scan[a:b]
                best = left[:, :, 0, None] + right[:, None, 0, :]
                for k in range(1, width):
                    np.maximum(best, left[:, :, k, None] + right[:, None, k, :], out=best)
                new[a:b] = best
            scan, d = np.maximum(new, NEG), 2 * d
        return scan

    def traces(self, chars: np.ndarray, entry: np.ndarray, size: int) -> np.ndarray:
        """Tokens of all chunks, each traced back by itself: first from every exit state to the entry state it came from, then,
        once the exit states are known, along the path."""
        width, n = self.longest, len(entry)
        came = np.empty((n, width), np.int64)
        for a, b in self._batches(n, size):
            _, gain = self._chunks(chars, a, b, size)
            back = self._advance(entry[a:b], gain, size)[1][:, 0]
            came[a:b] = self._trace(back, np.broadcast_to(np.arange(size, size + width), (b - a, width)))
        state = np.zeros(n + 1, np.int64)
        for c in range(n - 1, -1, -1):
            state[c] = came[c, state[c + 1]]
        out = []
        for a, b in self._batches(n, size):
            ids, gain = self._chunks(chars, a, b, size)
            back = self._advance(entry[a:b], gain, size)[1][:, 0]
            seen: list[tuple[np.ndarray, np.ndarray]] = []
            self._trace(back, size + state[a + 1 : b + 1][:, None], seen)
            chunk, end = (np.concatenate(x) for x in zip(*seen, strict=True))
            length = back[chunk, end].astype(np.int64)
            at = chunk * size + end - 1
            o = np.argsort(at, kind="stable")
            found, at = ids[length[o] - 1, at[o]], at[o] + a * size
            real = found != -3
            out.append(self._tokens(np.zeros(int(real.sum()), np.int64), found[real], chars[at[real]], 1)[0])
        return np.concatenate(out)

    @staticmethod
    def _batches(n: int, size: int) -> list[tuple[int, int]]:
        step = max(1, BATCH // size)
        return [(a, min(n, a + step)) for a in range(0, n, step)]

    def scan(self, text: str) -> tuple[bytes, int]:
        """A text or unit of any length: transfer matrices of its chunks, their associative scan, and a trace of its own for
        every chunk. Only the matrices (width x width for each chunk) and the tokens follow the length."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = CHUNK if len(chars) < 1 << 18 else 16 * CHUNK
        product = self.prefix(self.matrices(chars, size))
        entry = np.full((len(product), 1, self.longest), NEG)
        entry[0, 0, 0] = 0
        entry[1:, 0] = product[:-1, 0]
        score = int(product[-1, 0, 0])  # the last chunk is full: padding is free
        del product
        return self.traces(chars, entry, size).tobytes(), score

    @staticmethod
    def _trace(back: np.ndarray, start: np.ndarray, seen: list | None = None) -> np.ndarray:
        """Follows the last lengths from start [chunks, walkers] down to the entry states; seen gets (chunk, position)s."""
        at = start.astype(np.int64)
        row = np.arange(len(back))[:, None]
        while True:
            k = back[row, at].astype(np.int64)
            go = k > 0
            if not go.any():
                return at
            if seen is not None:
                c = np.flatnonzero(go[:, 0])
                seen.append((c, at[c, 0]))
            at = at - k

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, int]]:
        """(ids as int32 bytes, score) of whole texts."""
        whole = [SPACE + t.replace(SPACE, LITERAL).replace(" ", SPACE) if t else "" for t in texts]
        split = [self.units.findall(t) if len(t) <= GIANT else [] for t in whole]
        new = {u for own in split for u in own if u not in self.cache}
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = {u for own in split for u in own}
        short, long = sorted(u for u in new if len(u) <= CHUNK), [u for u in new if len(u) > CHUNK]
        for a in range(0, len(short), 50_000):
            self.cache.update(zip(short[a : a + 50_000], self.solve(short[a : a + 50_000]), strict=True))
        for u in long:
            self.cache[u] = self.scan(u)
        out = []
        for t, own in zip(whole, split, strict=True):
            if len(t) > GIANT:
                out.append(self.scan(t))
                continue
            got = [self.cache[u] for u in own]
            out.append((b"".join([g[0] for g in got]), sum([g[1] for g in got])))
        return out

    def decode(self, ids: bytes) -> str:
        whole = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, np.int32).tolist()))
        return whole[1:].decode("utf-8", "surrogatepass")


def codec(path: str) -> Codec:
    return Codec(load_pieces(path))


def encode(docs: DataFrame, tables: Codec, keep: list[str] | None = None) -> DataFrame:
    """The given columns (default doc_id), ids array<int> (null for a null text), n_tokens and score of every row's whole text."""
    keep = keep or ["doc_id"]
    text = free_name("text", keep)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = tables.encode(b.column(text).to_pylist())
        size = np.array([len(g[0]) // 4 for g in got])
        null = b.column(text).is_null()
        ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(np.frombuffer(b"".join(g[0] for g in got), np.int32)), mask=null)
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), ids, pa.array(size, pa.int64()), pa.array([float(g[1]) for g in got])], [*keep, "ids", "n_tokens", "score"])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, docs["text"].alias(text)).mapInArrow(by_piece(run, text, 2 << 20), ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "ids array<int>, n_tokens long, score double"]))


def decode(tokens: DataFrame, tables: Codec) -> DataFrame:
    """doc_id and text of encoded rows."""

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                texts = [None if x is None else tables.decode(np.array(x, np.int32).tobytes()) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(tokens.dtypes)['doc_id']}, text string")


def digest(docs: DataFrame, tables: Codec) -> DataFrame:
    """doc_id, n_chars, n_tokens, score, ids_sha256 and whether decoding gave the text back, of every row."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in b.column("text").to_pylist()]
        got = tables.encode(texts)
        cols = [
            b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(g[0]) // 4 for g in got], pa.int64()), pa.array([float(g[1]) for g in got]),
            pa.array([hashlib.sha256(g[0]).hexdigest() for g in got]), pa.array([tables.decode(g[0]) == t for g, t in zip(got, texts, strict=True)]),
        ]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_chars", "n_tokens", "score", "ids_sha256", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(by_piece(run, most=2 << 20), f"doc_id {dict(docs.dtypes)['doc_id']}, n_chars long, n_tokens long, score double, ids_sha256 string, round_trip boolean")
