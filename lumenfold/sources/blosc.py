"""The Blosc (version 1) container: blocks of shuffled elements, each packed by a general codec.

A buffer starts with 16 bytes: format version, codec version, flags, element size, then as 32-bit little-endian numbers the
unpacked size, the block size and the packed size. Unless the flags say that the bytes follow as they are, a table with the
place of every block comes next; a block is one stream or one stream for each byte of an element, and a stream that did not
get smaller is kept raw. The codecs of a stream are those that Arrow and zlib bring along; its own (blosclz) isn't one of
them, and buffers packed with it are refused.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa

# Fixed values of the public format: flag bits, codec numbers, and when a block is split into one stream per byte.
SHUFFLE, RAW, BITSHUFFLE, WHOLE = 0x1, 0x2, 0x4, 0x10
CODECS = {0: "blosclz", 1: "lz4", 2: "snappy", 3: "zlib", 4: "zstd"}
MOST_STREAMS, LEAST_STREAM = 16, 128
VERSION, HEADER = 2, 16
#: Bytes of a block that is written.
BLOCK = 1 << 18


def unpack_stream(raw: bytes, size: int, codec: str) -> bytes:
    if codec == "zlib":
        return zlib.decompress(raw)
    if codec not in ("zstd", "lz4", "snappy"):
        raise ValueError(f"streams packed with {codec} can't be read")
    return pa.decompress(raw, size, codec="lz4_raw" if codec == "lz4" else codec, asbytes=True)


def pack_stream(raw: bytes, codec: str, level: int) -> bytes:
    if codec == "zlib":
        return zlib.compress(raw, level)
    kind = "lz4_raw" if codec == "lz4" else codec
    return pa.Codec(kind, level if codec == "zstd" else None).compress(raw, asbytes=True)


def shuffle(block: bytes, size: int) -> bytes:
    """First bytes of all elements, then second bytes, and so on; a rest of less than an element stays behind them."""
    n = len(block) // size
    return np.frombuffer(block, np.uint8, n * size).reshape(n, size).T.tobytes() + block[n * size :]


def unshuffle(block: bytes, size: int) -> bytes:
    n = len(block) // size
    return np.frombuffer(block, np.uint8, n * size).reshape(size, n).T.tobytes() + block[n * size :]


def bitshuffle(block: bytes, size: int) -> bytes:
    """First bits of all elements, then second bits, and so on; blocks whose elements don't come in eights stay as they are."""
    n = len(block) // size
    if n % 8:
        return block
    bits = np.unpackbits(np.frombuffer(block, np.uint8, n * size).reshape(n, size), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").tobytes() + block[n * size :]


def bitunshuffle(block: bytes, size: int) -> bytes:
    n = len(block) // size
    if n % 8:
        return block
    bits = np.unpackbits(np.frombuffer(block, np.uint8, n * size).reshape(size * 8, n // 8), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").tobytes() + block[n * size :]


def decompress(raw: bytes) -> bytes:
    """The bytes that a buffer holds; ValueError where it is cut off or packed by an unknown codec."""
    if len(raw) < HEADER:
        raise ValueError("not a Blosc buffer")
    version, _, flags, size, whole, block, packed = struct.unpack_from("<BBBBIII", raw)
    if version not in (1, 2) or packed > len(raw) or not size:
        raise ValueError("not a whole Blosc buffer")
    if flags & RAW:
        return raw[HEADER : HEADER + whole]
    codec = CODECS.get(flags >> 5, str(flags >> 5))
    blocks = -(-whole // block) if whole else 0
    out = []
    for i, at in enumerate(struct.unpack_from(f"<{blocks}i", raw, HEADER)):
        length = min(block, whole - i * block)
        streams = size if not flags & WHOLE and size <= MOST_STREAMS and block // size >= LEAST_STREAM and length == block else 1
        part, got = length // streams, []
        for _ in range(streams):
            n = struct.unpack_from("<i", raw, at)[0]
            at += 4
            if n < 0 or at + n > packed:
                raise ValueError("not a whole Blosc buffer")
            got.append(raw[at : at + n] if n == part else unpack_stream(raw[at : at + n], part, codec))
            at += n
        b = b"".join(got)
        out.append(unshuffle(b, size) if flags & SHUFFLE and size > 1 else bitunshuffle(b, size) if flags & BITSHUFFLE else b)
    return b"".join(out)


def compress(raw: bytes, size: int, codec: str = "zstd", level: int = 5, mode: int = SHUFFLE, block: int = 0, split: bool = False) -> bytes:
    """A buffer of elements of `size` bytes. mode: SHUFFLE, BITSHUFFLE or 0; block: bytes of a block (0: BLOCK); split: one stream
    for each byte of an element."""
    number = {v: k for k, v in CODECS.items()}[codec]
    size = size if 0 < size < 256 else 1
    block = max(size, (block or BLOCK) // size * size)
    streams = size if split and size <= MOST_STREAMS and block // size >= LEAST_STREAM else 1
    flags = (mode if size > 1 or mode == BITSHUFFLE else 0) | number << 5 | (0 if split else WHOLE)
    blocks = -(-len(raw) // block)
    at, places, body = HEADER + 4 * blocks, [], []
    for i in range(blocks):
        b = raw[i * block : (i + 1) * block]
        b = shuffle(b, size) if flags & SHUFFLE else bitshuffle(b, size) if flags & BITSHUFFLE else b
        places.append(at)
        part = len(b) // (streams if len(b) == block else 1)
        for a in range(0, len(b), part):
            s = pack_stream(b[a : a + part], codec, level)
            s = s if len(s) < part else b[a : a + part]
            body.append(struct.pack("<i", len(s)) + s)
            at += 4 + len(s)
    if at >= len(raw) + HEADER:
        return struct.pack("<BBBBIII", VERSION, 1, flags | RAW, size, len(raw), block, len(raw) + HEADER) + raw
    return struct.pack(f"<BBBBIII{blocks}i", VERSION, 1, flags, size, len(raw), block, at, *places) + b"".join(body)
