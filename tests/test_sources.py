"""Sources and sinks: byte formats against hand-made files, and what is opened for a condition."""

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from lumenfold.sources import blosc, spool, store, tiff


def dense(df, shape):
    out = np.zeros(shape)
    p = df.toPandas()
    out[tuple(p[c] for c in (["c"] if len(shape) == 4 else []) + ["x", "z", "y"])] = p.v
    return out


def voxels(spark, a):
    at = np.indices(a.shape).reshape(a.ndim, -1)
    names = (["c"] if a.ndim == 4 else []) + ["x", "z", "y"]
    rows = [(*map(int, i), int(v)) for *i, v in zip(*at, a.ravel(), strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names) + ", v int")


# blosc


@pytest.mark.parametrize("codec", ["zstd", "lz4", "zlib", "snappy"])
def test_blosc_round_trips(codec):
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 1000, 70_001):
        for kind in ("u1", "<u2", "<f8"):
            for a in (r.integers(0, 200, n).astype(kind), (np.arange(n) // 9).astype(kind)):
                for mode in (0, blosc.SHUFFLE, blosc.BITSHUFFLE):
                    for split in (False, True):
                        raw = a.tobytes()
                        assert blosc.decompress(blosc.compress(raw, a.itemsize, codec, 5, mode, 4096 if n % 2 else 0, split)) == raw


def test_blosc_bytes_by_hand():
    """Buffers put together here from the public description of the format, not by the encoder."""
    head = lambda flags, size, whole, block, packed: bytes([2, 1, flags, size]) + struct.pack("<III", whole, block, packed)
    assert blosc.decompress(head(0x2, 2, 6, 6, 22) + b"abcdef") == b"abcdef"
    # 3 elements of 2 bytes, bytes shuffled, one stream that didn't get smaller: a c e | b d f
    stored = struct.pack("<i", 20) + struct.pack("<i", 6) + b"acebdf"
    assert blosc.decompress(head(0x1 | 0x10 | 4 << 5, 2, 6, 6, 16 + len(stored)) + stored) == b"abcdef"
    # 200 elements of 2 bytes: a block of 400 bytes split into two streams of 200, each deflated; then 3 elements left over
    low, high = bytes(range(200)), bytes(200)
    streams = [zlib.compress(low), zlib.compress(high)]
    first = b"".join(struct.pack("<i", len(s)) + s for s in streams)
    rest = struct.pack("<i", 6) + bytes([1, 2, 3, 9, 9, 9])
    table = struct.pack("<ii", 24, 24 + len(first))
    got = blosc.decompress(head(0x1 | 3 << 5, 2, 406, 400, 24 + len(first) + len(rest)) + table + first + rest)
    assert np.frombuffer(got, "<u2").tolist() == [*range(200), 1 + 9 * 256, 2 + 9 * 256, 3 + 9 * 256]
    # 8 elements of 1 byte, bits shuffled: first bits of all, then second bits
    stored = struct.pack("<i", 20) + struct.pack("<i", 8) + bytes([0b10101010, 0b11001100, 0b11110000, 0, 0, 0, 0, 0])
    assert blosc.decompress(head(0x4 | 0x10 | 4 << 5, 1, 8, 8, 16 + len(stored)) + stored) == bytes(range(8))
    # zstd through Arrow, which frames it as the format asks
    z = pa.compress(bytes(1000), codec="zstd", asbytes=True)
    stored = struct.pack("<i", 20) + struct.pack("<i", len(z)) + z
    assert blosc.decompress(head(0x10 | 4 << 5, 4, 1000, 1000, 16 + len(stored)) + stored) == bytes(1000)
    for bad in (b"", b"xx", head(0x10, 1, 8, 8, 99), head(0x10, 1, 300, 300, 28) + struct.pack("<ii", 20, 4) + b"abcd", head(0x10 | 4 << 5, 1, 8, 8, 24) + struct.pack("<ii", 20, 99)):
        with pytest.raises(ValueError):
            blosc.decompress(bad)


def test_blosc_store_with_channels(spark, tmp_path):
    a = np.random.default_rng(3).integers(0, 60000, (3, 9, 5, 6))
    for separator in (".", "/"):
        path = str(tmp_path / ("nested" if separator == "/" else "flat"))
        store.write_store(store.to_chunks(voxels(spark, a), a.shape, (1, 4, 3, 4)), path, a.shape, (1, 4, 3, 4), codec="blosc", separator=separator)
        about = json.load(open(f"{path}/.zarray"))
        assert about["compressor"] == {"id": "blosc", "cname": "zstd", "clevel": 5, "shuffle": 1, "blocksize": 0} and about["shape"] == [3, 9, 5, 6]
        assert (dense(store.store_to_voxels(store.read_store(spark, path)), a.shape) == a).all()
        s = store.Store(path)
        assert (s.box([1, 2, 1, 0], [3, 9, 4, 5]) == a[1:3, 2:9, 1:4, 0:5]).all()
        part = store.read_store(spark, path, region=[(1, 3), (4, 8), (0, 5), (0, 4)])
        assert part.count() == 4 and set(part.select("c").toPandas().c) == {1, 2}
        assert len(s.present()) == 3 * 3 * 2 * 2
    # chunks that hold several channels are read as one row a channel
    wide = tmp_path / "wide"
    wide.mkdir()
    (wide / ".zarray").write_text(json.dumps(store.description([3, 9, 5, 6], [2, 9, 5, 6], "blosc")))
    s = store.Store(str(wide))
    for i in range(2):
        name, payload = s.put_chunk((i, 0, 0, 0), a[2 * i : 2 * i + 2])
        (wide / name).write_bytes(payload)
    assert (dense(store.store_to_voxels(store.read_store(spark, str(wide))), a.shape) == a).all()
    assert store.read_store(spark, str(wide)).where("c = 2").count() == 1
    with pytest.raises(Exception, match="chunks of their own"):
        store.write_store(store.to_chunks(voxels(spark, a), a.shape, (1, 4, 3, 4)), str(tmp_path / "bad"), a.shape, (3, 4, 3, 4))


# conditions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conditions_choose_chunks(spark, tmp_path):
    a = np.random.default_rng(4).integers(0, 60000, (32, 8, 8))
    path = tmp_path / "s"
    store.write_store(store.to_chunks(voxels(spark, a), a.shape, (4, 4, 4)), str(path), a.shape, (4, 4, 4))
    df = store.read_store(spark, str(path), chunks_at_once=1)
    assert df.rdd.getNumPartitions() == 32 and df.count() == 32
    few = df.where("x0 >= 16 and x0 < 24 and z0 = 0 and nx = 4")
    assert few.count() == 4 and df.count() == 32  # conditions of one query don't stay for the next
    assert (dense(store.store_to_voxels(few), a.shape)[16:24, :4] == a[16:24, :4]).all()
    assert df.where("x0 = 1").count() == 0 and df.where("x0 = 4 or z0 = 4").count() == 18 and df.where("not x0 = 4").count() == 28
    both = df.where("x0 = 4").union(df.where("x0 = 8"))
    assert sorted(r[0] for r in both.select("x0").distinct().collect()) == [4, 8]
    # the condition stands below the function that opens chunks, and without data there is none
    text = plan(few.select("x0", "data"))
    assert text.index("ArrowEvalPython") < text.index("Filter") and "ArrowEvalPython" not in plan(few.select("x0"))
    # what isn't asked for isn't opened
    for name in store.Store(str(path)).present() - {"4.0.0", "4.0.1", "4.1.0", "4.1.1"}:
        (path / name).write_bytes(b"damaged")
    assert (dense(store.store_to_voxels(df.where("x0 = 16")), a.shape)[16:20] == a[16:20]).all()
    assert (dense(store.store_to_voxels(store.read_store(spark, str(path), region=[(17, 19), (1, 8), (0, 3)])), a.shape)[17:19, 1:, :3] == a[17:19, 1:, :3]).all()


def test_unread_chunks_may_be_damaged(spark, tmp_path):
    a = np.ones((8, 4, 4), int)
    path = tmp_path / "s"
    store.write_store(store.to_chunks(voxels(spark, a), a.shape, (4, 4, 4)), str(path), a.shape, (4, 4, 4), codec="blosc")
    (path / "1.0.0").write_bytes(b"damaged")
    assert len(store.read_store(spark, str(path)).where("x0 < 4").collect()) == 1
    with pytest.raises(Exception, match="Blosc"):
        store.read_store(spark, str(path)).collect()


# spools


def test_packed_spools_are_split(spark, tmp_path):
    f = np.random.default_rng(6).integers(0, 4096, (50, 4, 6))
    rows = spark.createDataFrame([(7 + i, x.ravel().tolist()) for i, x in enumerate(f)], "frame long, data array<int>")
    spool.write_spools(rows, str(tmp_path / "p"), 4, 6, packed=True, at_once=64, per_piece=8)
    path = next(str(p) for p in (tmp_path / "p").iterdir() if p.name.endswith(".zst"))
    fs, p = spool._open(path)
    table = spool.seek_table(fs, p)
    assert len(table) == 1 + 7 and sum(t[2] for t in table) == table[0][2] + 50 * 36
    # any reader of zstd sees one stream
    with pa.OSFile(path) as raw, pa.input_stream(raw, compression="zstd") as z:
        assert len(z.read()) == table[0][2] + 50 * 36
    df = spool.read_spools(spark, path, frames_at_once=10)  # not in step with the pieces
    assert df.rdd.getNumPartitions() == 5
    assert [r.data for r in df.orderBy("frame").collect()] == [(x.ravel() * 16).tolist() for x in f]
    source = spark.read.format("fli").option("framesAtOnce", 10).load(path)
    assert source.rdd.getNumPartitions() == 5 and sorted(r.frame for r in source.collect()) == list(range(7, 57))
    few = df.where("frame >= 20 and frame < 31")
    assert [(r.frame, r.data) for r in few.orderBy("frame").collect()] == [(k, (f[k - 7].ravel() * 16).tolist()) for k in range(20, 31)]
    assert df.where("frame in (1, 2)").count() == 0
    # a spool of one zstd frame has no table and stays one partition
    spool.write_spool(str(tmp_path / "a.fli.zst"), f)
    whole = spool.read_spools(spark, str(tmp_path / "a.fli.zst"), frames_at_once=10)
    assert whole.count() == 50 and whole.where("frame < 3").count() == 3
    # pieces without a frame that is asked for aren't unpacked
    raw = bytearray(open(path, "rb").read())
    for at, size, _ in table[4:]:
        raw[at : at + size] = bytes(size)
    open(path, "wb").write(raw)
    assert [r.data for r in spool.read_spools(spark, path, frames_at_once=10).where("frame < 31").orderBy("frame").collect()] == [(x.ravel() * 16).tolist() for x in f[:24]]
    with pytest.raises(Exception):
        spool.read_spools(spark, path).where("frame = 31").collect()


def test_only_frames_asked_for_are_read(spark, tmp_path):
    f = np.random.default_rng(6).integers(0, 4096, (50, 4, 6))
    for name in ("a.fli", "b.fli"):
        spool.write_spool(str(tmp_path / name), f)
    df = spool.read_spools(spark, str(tmp_path), frames_at_once=8)
    assert df.count() == 100 and df.rdd.getNumPartitions() == 14
    few = df.where(f"frame between 10 and 13 and path = '{tmp_path}/b.fli'")
    assert [r.data for r in few.orderBy("frame").collect()] == [(x.ravel() * 16).tolist() for x in f[10:14]]
    text = plan(few)
    assert text.index("ArrowEvalPython") < text.index("Filter") and df.count() == 100


def test_seek_tables_by_hand(tmp_path):
    two = [pa.compress(b"a" * 500, codec="zstd", asbytes=True), pa.compress(b"b" * 70, codec="zstd", asbytes=True)]
    entries = b"".join(struct.pack("<III", len(z), n, 0) for z, n in zip(two, (500, 70), strict=True))  # with checksums
    end = struct.pack("<II", 0x184D2A5E, len(entries) + 9) + entries + struct.pack("<IBI", 2, 0x80, 0x8F92EAB1)
    (tmp_path / "x").write_bytes(b"".join(two) + end)
    fs, p = spool._open(str(tmp_path / "x"))
    assert spool.seek_table(fs, p) == [(0, len(two[0]), 500), (len(two[0]), len(two[1]), 70)]
    for other in (b"", b"short", b"".join(two), b"x" + b"".join(two) + end):
        (tmp_path / "y").write_bytes(other)
        assert spool.seek_table(*spool._open(str(tmp_path / "y"))) is None


def test_spools_of_different_sizes_are_refused(spark, tmp_path):
    spool.write_spool(str(tmp_path / "a.fli"), np.zeros((2, 4, 6), int))
    spool.write_spool(str(tmp_path / "b.fli"), np.zeros((2, 4, 8), int))
    with pytest.raises(ValueError, match="different sizes"):
        spool.spools_to_store(spark, str(tmp_path), str(tmp_path / "out"), (2, 4, 4))


# tiff


def pack_lzw(raw):
    """An encoder of the public format, written for this test: codes of 9 to 12 bits, first bit first, growing one code early."""
    out, bits, n = 0, 0, 0
    table, width, word = {bytes([i]): i for i in range(256)}, 9, b""
    codes = [(256, 9)]
    size = 258
    for c in raw:
        c = bytes([c])
        if word + c in table:
            word += c
            continue
        codes.append((table[word], width))
        table[word + c], size = size, size + 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            codes.append((256, width))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        word = c
    if word:
        codes.append((table[word], width))
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    codes.append((257, width))
    for code, w in codes:
        out, bits = out << w | code, bits + w
    pad = -bits % 8
    return (out << pad).to_bytes((bits + pad) // 8, "big")


def test_lzw_and_packbits():
    r = np.random.default_rng(2)
    for raw in (b"", b"a", b"aaaaaaa", bytes(range(256)) * 3, r.integers(0, 4, 30_000).astype("u1").tobytes(), r.integers(0, 256, 20_000).astype("u1").tobytes()):
        assert tiff.unpack_lzw(pack_lzw(raw)) == raw
    # the format's own example: 7 7 7 8 8 7 7 6 6
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    raw = int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")
    assert list(tiff.unpack_lzw(raw)) == [7, 7, 7, 8, 8, 7, 7, 6, 6]
    assert tiff.unpack_bits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x80, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])) == bytes.fromhex("aaaaaa80002aaaaaaaaa80002a22aaaaaaaaaaaaaaaaaaaa")


def by_hand(big, order, tiled, packing, predictor, a):
    """A file of one page with its directory behind its segments, put together from the public description."""
    o, n16 = order, {"none": 1, "lzw": 5, "deflate": 8}[packing]
    rows, cols = (16, 16) if tiled else (3, a.shape[1])
    body = []
    for z in range(0, a.shape[0], rows):
        for y in range(0, a.shape[1], cols):
            p = a[z : z + rows, y : y + cols]
            p = np.pad(p, ((0, rows - p.shape[0]), (0, cols - p.shape[1]))) if tiled else p
            p = np.concatenate([p[:, :1], np.diff(p, axis=1)], axis=1) if predictor else p
            raw = p.astype(a.dtype.newbyteorder(o)).tobytes()
            body.append(pack_lzw(raw) if packing == "lzw" else zlib.compress(raw) if packing == "deflate" else raw)
    out = bytearray(struct.pack(o + "2sHHHQ", b"II" if o == "<" else b"MM", 43, 8, 0, 0) if big else struct.pack(o + "2sHI", b"II" if o == "<" else b"MM", 42, 0))
    places = []
    for b in body:
        places.append(len(out))
        out += b
    kind, code = (16, "Q") if big else (4, "I")
    at = {}
    for name, values in (("places", places), ("bytes", [len(b) for b in body])):
        at[name] = len(out)
        out += struct.pack(f"{o}{len(values)}{code}", *values)
    start = len(out)
    fields = [(256, 3, 1, a.shape[1]), (257, 3, 1, a.shape[0]), (258, 3, 1, a.itemsize * 8), (259, 3, 1, n16), (277, 3, 1, 1), (317, 3, 1, 1 + predictor), (339, 3, 1, {"u": 1, "i": 2, "f": 3}[a.dtype.kind])]
    lists = [(kind, len(body), at[n] if len(body) > 1 else v[0]) for n, v in (("places", places), ("bytes", [len(b) for b in body]))]
    fields += [(322, 3, 1, cols), (323, 3, 1, rows), (324, *lists[0]), (325, *lists[1])] if tiled else [(278, 3, 1, rows), (273, *lists[0]), (279, *lists[1])]
    fields.sort()
    out += struct.pack(o + ("Q" if big else "H"), len(fields))
    for tag, k, n, v in fields:
        width = 8 if big else 4
        value = struct.pack(o + ("H" if k == 3 else code), v).ljust(width, b"\0")
        out += struct.pack(o + ("HHQ" if big else "HHI"), tag, k, n) + value
    out += bytes(8 if big else 4)
    struct.pack_into(o + code, out, 8 if big else 4, start)
    return bytes(out)


def test_tiffs_by_hand(spark, tmp_path):
    r = np.random.default_rng(9)
    want = {}
    for big in (False, True):
        for order in "<>":
            for tiled in (False, True):
                for packing, predictor, kind in (("none", 0, "u2"), ("lzw", 1, "u2"), ("deflate", 1, "u1"), ("lzw", 0, "f4")):
                    a = r.integers(0, 250, (20, 37)).astype(kind)
                    name = f"{big:d}{'le' if order == '<' else 'be'}{tiled:d}{packing}{predictor}{kind}.tif"
                    (tmp_path / name).write_bytes(by_hand(big, order, tiled, packing, predictor, a))
                    want[name] = a
    p = tiff.segments_to_pixels(tiff.read_tiff_volume(spark, str(tmp_path))).toPandas()
    for path, g in p.groupby("path"):
        out = np.full((20, 37), -1.0)
        out[g.z, g.y] = g.v
        assert (out == want.pop(path.rpartition("/")[2])).all()
    assert not want


@pytest.mark.parametrize("how", [{"rows": 3}, {"rows": 16, "columns": 32}, {"packing": "none", "rows": 100}, {"packing": "zstd", "dtype": "<f4", "rows": 7}, {"dtype": "<i2", "rows": 1}])
def test_tiff_volumes(spark, tmp_path, how):
    a = np.random.default_rng(5).integers(-300 if "i2" in str(how) else 0, 30_000, (11, 20, 37))
    planes = spark.createDataFrame([(i, 20, 37, x.ravel().astype(float).tolist()) for i, x in enumerate(a)], "x long, height int, width int, data array<double>")
    tiff.write_tiff_volumes(tiff.volume_files(planes, F.format_string("sub/v%d.tif", F.col("file")), 4), str(tmp_path), **how)
    assert sorted(p.name for p in (tmp_path / "sub").iterdir() if not p.name.startswith(".")) == ["v0.tif", "v1.tif", "v2.tif"]
    with open(tmp_path / "sub/v1.tif", "rb") as f:
        got = list(tiff.pages(f))
    assert len(got) == 4 and (got[0].height, got[0].width) == (20, 37)
    t = tiff.read_tiff_volume(spark, str(tmp_path), group=1)
    p = tiff.segments_to_pixels(t).toPandas()
    out = np.full(a.shape, -9.0)
    out[p.path.str.extract(r"v(\d)")[0].astype(int) * 4 + p.page, p.z, p.y] = p.v
    assert (out == a).all()


def test_a_page_is_read_by_its_strips(spark, tmp_path):
    a = np.arange(5 * 12 * 6).reshape(5, 12, 6)
    planes = spark.createDataFrame([(i, 12, 6, x.ravel().astype(float).tolist()) for i, x in enumerate(a)], "x long, height int, width int, data array<double>")
    tiff.write_tiff_volumes(tiff.volume_files(planes, F.lit("v.tif"), 9), str(tmp_path), rows=4)
    path = tmp_path / "v.tif"
    with open(path, "rb") as f:
        got = list(tiff.pages(f))
    raw = bytearray(path.read_bytes())
    keep = list(got[3].segments())[1]
    for g in got:
        for s in g.segments():
            if s != keep:
                raw[s[4] : s[4] + s[5]] = bytes(s[5])
    path.write_bytes(raw)
    t = tiff.read_tiff_volume(spark, str(tmp_path)).where("page = 3 and z0 between 1 and 5")
    assert [r.data for r in t.collect()] == [a[3, 4:8].ravel().tolist()]
    text = plan(t)
    assert text.index("ArrowEvalPython") < text.index("Filter")
    assert tiff.read_tiff_volume(spark, str(tmp_path)).where("page = 3").select("z0", "height").count() == 3

    class Counting:
        def __init__(self, f):
            self.f, self.bytes = f, 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            out = self.f.read(n)
            self.bytes += len(out)
            return out

    big = np.random.default_rng(1).random((3, 700, 400))
    planes = spark.createDataFrame([(i, 700, 400, x.ravel().tolist()) for i, x in enumerate(big)], "x long, height int, width int, data array<double>")
    tiff.write_tiff_volumes(tiff.volume_files(planes, F.lit("w.tif"), 9), str(tmp_path), dtype="<f8", packing="none")
    with open(tmp_path / "w.tif", "rb") as f:
        c = Counting(f)
        assert len(list(tiff.pages(c))) == 3 and c.bytes < 3 * 5000


def test_tiffs_that_are_refused(spark, tmp_path):
    import io

    for bad in (b"", b"GIF89a__", b"II*\0\x08\0\0\0", b"II+\0\x04\0\0\0" + bytes(8)):
        with pytest.raises((ValueError, struct.error)):
            list(tiff.pages(io.BytesIO(bad)))
    circle = bytearray(by_hand(False, "<", False, "none", 0, np.ones((3, 4), "u1")))
    at = struct.unpack_from("<I", circle, 4)[0]
    circle[-4:] = struct.pack("<I", at)
    with pytest.raises(ValueError, match="circle"):
        list(tiff.pages(io.BytesIO(bytes(circle))))
    gap = spark.createDataFrame([("a.tif", 0, 1, 1, [1.0]), ("a.tif", 2, 1, 1, [1.0])], "name string, page int, height int, width int, data array<double>")
    with pytest.raises(Exception, match="is due"):
        tiff.write_tiff_volumes(gap, str(tmp_path))
    with pytest.raises(Exception, match="multiples of 16"):
        tiff.write_tiff_volumes(gap.limit(1), str(tmp_path), rows=8, columns=8)
