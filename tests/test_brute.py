"""Queries without an SQL twin against plain NumPy versions of the same definitions, on the smallest tables."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest

from lumenfold.operators import arith, catalog, geometry, linalg
from lumenfold.sources import images, spool, store
from tests.test_operators import brute_components, dense, vox


@pytest.fixture(scope="module")
def frames(small):
    """The smallest table's volume, (x, z, y)."""
    e = pd.read_parquet(f"{small}/embeddings.parquet").sort_values("vec_id")
    assert e.vec_id.tolist() == list(range(len(e)))
    px = np.clip(np.rint((np.stack(e.embedding).astype(np.float32).astype(float) + 1) * 2047.5), 0, 4095).astype(int) * 16
    return px.reshape(-1, 8, 8)


def got(spark, small, name):
    return catalog.QUERIES[name](spark, small).toPandas()


def test_unmix_nonnegative_is_optimal(spark, small, frames):
    r = got(spark, small, "unmix_nonnegative")
    a = np.array(catalog.FLCH, float).T
    u = r[[f"u_c{k + 1}" for k in range(5)]].to_numpy()
    v = frames[r.x, r.z][:, :5].astype(float)
    assert len(r) == len(frames) * 8 and (u >= 0).all()
    # no descent direction: the gradient is 0 where u > 0 and not negative elsewhere
    g = (u @ a.T - v) @ a
    assert (g > -1e-4 * np.abs(v).max()).all() and np.abs(g[u > 0]).max() < 1e-3


def test_illumination_inverse(spark, small, frames):
    r = got(spark, small, "illumination_inverse")
    q = [np.array(catalog.FLCH, float), np.array([[row[(j + 1) % 5] for j in range(5)] for row in catalog.FLCH])]
    assert len(r) == len(frames) * 8
    for row in r.iloc[::7].itertuples():
        p = frames[row.x, row.z].astype(float)
        g = sum((p[5 + k] + 1) / 65536 * q[k] for k in range(2))
        want = np.zeros(5) if abs(np.linalg.det(g)) <= 1e-12 else np.linalg.pinv(g) @ p[:5]
        assert np.allclose([getattr(row, f"u_c{k + 1}") for k in range(5)], want, rtol=1e-6, atol=1e-6)


def spline_matrix(n):
    """Samples of a cubic B-spline with mirrored edges, as a matrix on its coefficients."""
    m = np.zeros((n, n))
    for i in range(n):
        for d, w in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
            j = abs(i + d)
            m[i, 2 * (n - 1) - j if j > n - 1 else j] += w
    return m


def test_cubic_warp(spark, small, frames):
    r = got(spark, small, "cubic_warp")
    n = len(frames)
    c = frames.astype(float)
    for axis in range(3):
        c = np.moveaxis(np.linalg.solve(spline_matrix(c.shape[axis]), np.moveaxis(c, axis, 0).reshape(c.shape[axis], -1)).reshape(np.moveaxis(c, axis, 0).shape), 0, axis)
    inv = np.linalg.inv(linalg.compose_affine(rotation=5.0, deskew=-7.0, tx=4.5))
    b = lambda t: (2 / 3 - t * t + abs(t) ** 3 / 2) if abs(t) < 1 else (2 - abs(t)) ** 3 / 6 if abs(t) < 2 else 0.0
    fold = lambda i, n: 2 * (n - 1) - abs(i) if abs(i) > n - 1 else abs(i)
    for row in r.sample(300, random_state=1).itertuples():
        p = np.round(inv[:3, :3] @ [row.x, row.z, row.y] + inv[:3, 3], 9)
        want = 0.0
        if (p >= 0).all() and (p <= np.array([n, 8, 8]) - 1).all():
            base = np.floor(p).astype(int)
            for o in itertools.product(range(-1, 3), repeat=3):
                i = base + o
                want += c[tuple(fold(int(k), m) for k, m in zip(i, (n, 8, 8), strict=True))] * math.prod(b(float(x - k)) for x, k in zip(p, i, strict=True))
        assert row.v == pytest.approx(want, abs=0.5)  # the halo cuts the filter's tail


def test_two_threshold_objects(spark, small, frames):
    off = [o for o in itertools.product((-1, 0, 1), repeat=3) if any(o)]
    loose, strict = brute_components(frames > 35000, off), brute_components(frames > 39500, off)
    inside = {}
    for p, s in strict.items():
        inside.setdefault(loose[p], set()).add(s)
    merged = {k for k, v in inside.items() if len(v) >= 2}
    want = {p for p, k in loose.items() if k not in merged} | {p for p in strict if loose[p] in merged}
    r = got(spark, small, "two_threshold_objects")
    assert len(merged) > 0 and {(a.x, a.z, a.y) for a in r.itertuples()} == want and len(r) == len(want)


def test_equalise_frames(spark, small, frames):
    r = got(spark, small, "equalise_frames")
    out = dense(vox_frame(spark, r), frames.shape)
    for x in (0, 3, len(frames) - 1):
        img = frames[x].astype(float)
        q = np.minimum(((img - img.min()) / (img.max() - img.min()) * 256).astype(int), 255)
        curve = {}
        for tz, ty in itertools.product(range(2), repeat=2):
            tile = q[tz * 4 : tz * 4 + 4, ty * 4 : ty * 4 + 4].ravel().tolist()
            most = max(1.0, 0.01 * len(tile))
            count = [float(tile.count(k)) for k in range(256)]
            over = sum(max(k - most, 0) for k in count)
            count = [min(k, most) + over / 256 for k in count]
            curve[tz, ty] = np.cumsum(count) / sum(count)
        for z, y in itertools.product(range(8), repeat=2):
            gz, gy = min(max((z + 0.5) / 4 - 0.5, 0), 1), min(max((y + 0.5) / 4 - 0.5, 0), 1)
            want = sum(wz * wy * curve[a, b][q[z, y]] for a, wz in ((0, 1 - gz), (1, gz)) for b, wy in ((0, 1 - gy), (1, gy)))
            assert out[x, z, y] == pytest.approx(want, abs=1e-9)


def vox_frame(spark, p):
    return spark.createDataFrame(p[["x", "z", "y", "v"]])


def test_detect_and_measure(spark, small, frames):
    r = got(spark, small, "detect_and_measure").sort_values("label").reset_index(drop=True)
    n = len(frames)
    on = np.zeros(frames.shape, bool)
    for x0 in range(0, n, 16):
        patch = np.zeros((16, 16, 16))
        part = frames[x0 : x0 + 16]
        patch[: len(part), :8, :8] = part
        logit = (part - patch.mean()) / patch.std() - 2.0
        on[x0 : x0 + 16] = 1 / (1 + np.exp(-logit)) > 0.6
    off = [o for o in itertools.product((-1, 0, 1), repeat=3) if any(o)]
    parts = {}
    for p, k in brute_components(on, off).items():
        parts.setdefault((k[0] * 8 + k[1]) * 8 + k[2], []).append(p)
    objects = {k: v for k, v in parts.items() if len(v) >= 2}
    assert r.label.tolist() == sorted(objects) and len(objects) > 3
    # layers: nearest object within 3, the smallest label where distances are equal
    near = {}
    for k, pts in sorted(objects.items()):
        for p in pts:
            for o in itertools.product(range(-3, 4), repeat=3):
                d = sum(i * i for i in o)
                q = tuple(a + b for a, b in zip(p, o, strict=True))
                if d <= 9 and (q not in near or (d, k) < near[q]):
                    near[q] = (d, k)
    layers = {}
    for q, (d, k) in near.items():
        layers.setdefault((k, math.ceil(math.sqrt(d)) + 1), []).append(q)
    copies = [np.roll(frames, c, axis=1) for c in range(5)]
    inside = lambda q: 0 <= q[0] < n and 0 <= q[1] < 8 and 0 <= q[2] < 8
    for row in r.itertuples():
        for layer, c in itertools.product((1, 2, 3, 4), range(5)):
            pts = [q for q in layers.get((row.label, layer), []) if inside(q)]
            want = np.mean([copies[c][q] for q in pts]) if pts else 0.0
            assert getattr(row, f"ch{c + 1}_l{layer}") == pytest.approx(want)
        assert row.vol_l1 == len(objects[row.label])


def test_resize_volume(spark, small, frames):
    r = got(spark, small, "resize_volume")
    n, to = len(frames), (-(-len(frames) // 3), 4, 12)
    a = frames.astype(float)
    for axis, o in enumerate(to):
        size, b = a.shape[axis], np.moveaxis(a, axis, 0)
        sigma = max(0.0, (size / o - 1) / 2)
        mirror = lambda i, m=size: i if 0 <= i < m else abs(i) if i < 0 else 2 * (m - 1) - i
        if sigma:
            k = range(-int(4 * sigma + 0.5), int(4 * sigma + 0.5) + 1)
            w = np.array([math.exp(-0.5 * (d / sigma) ** 2) for d in k])
            w /= w.sum()
            b = np.stack([sum(x * b[mirror(i + d)] for d, x in zip(k, w, strict=True)) for i in range(size)])
        at = [(i + 0.5) * size / o - 0.5 for i in range(o)]
        a = np.moveaxis(np.stack([(1 - (p - math.floor(p))) * b[mirror(math.floor(p))] + (p - math.floor(p)) * b[mirror(math.floor(p) + 1)] for p in at]), 0, axis)
    assert n > 20 and np.allclose(dense(vox_frame(spark, r), to), a)


def test_register_channels(spark, small, frames):
    r = got(spark, small, "register_channels")
    n = len(frames)
    q = {1: frames[:, :4, :4], 2: frames[:, 4:, :4], 3: frames[:, :4, 4:], 4: frames[:, 4:, 4:]}
    small_ = frames.astype(float)
    for axis in (1, 2):  # two samples each, behind a Gaussian of half a sample
        w = np.array([math.exp(-0.5 * (d / 0.5) ** 2) for d in (-2, -1, 0, 1, 2)])
        w /= w.sum()
        b = np.moveaxis(small_, axis, 0)
        pad = b[[2, 1, 0, 1, 2, 3, 4, 5, 6, 7, 6, 5]]
        b = sum(w[k] * pad[k : k + 8] for k in range(5))
        small_ = np.moveaxis((b[0::2] + b[1::2]) / 2, 0, axis)
    for ch in range(5):
        out = dense(vox_frame(spark, r[r.ch == ch]), (n, 4, 4))
        if ch == 0:
            assert np.array_equal(out, np.floor(np.clip(small_[:, ::-1, ::-1], 0, 65535)))
            continue
        for z, y in itertools.product(range(4), repeat=2):
            sz, sy = z + 0.5 * ch, y - 0.25 * ch
            want = np.zeros(n)
            for a, b in itertools.product((math.floor(sz), math.floor(sz) + 1), (math.floor(sy), math.floor(sy) + 1)):
                if 0 <= a < 4 and 0 <= b < 4:
                    want += (1 - abs(sz - a)) * (1 - abs(sy - b)) * q[ch][:, a, b]
            assert np.allclose(out[:, z, y], np.floor(want + 1e-9), atol=1)


# sources


def test_store_of_uneven_size(spark, tmp_path):
    a = np.random.default_rng(5).integers(0, 60000, (13, 5, 7))
    for codec in ("none", "zstd", "zlib", "gzip"):
        path = str(tmp_path / codec)
        store.write_store(store.to_chunks(vox(spark, a), a.shape, (4, 3, 4)), path, a.shape, (4, 3, 4), codec=codec)
        assert (dense(store.store_to_voxels(store.read_store(spark, path)), a.shape) == a).all()
        part = store.store_to_voxels(store.read_store(spark, path, region=[(3, 9), (0, 2), (6, 7)]))
        assert part.count() == 12 and part.agg({"x": "min"}).first()[0] == 3
        with pytest.raises(FileExistsError):
            store.write_store(store.to_chunks(vox(spark, a), a.shape, (4, 3, 4)), path, a.shape, (4, 3, 4), resume=False)
    (tmp_path / "none" / "0.0.0").unlink()  # a chunk that is missing holds the fill value
    assert (dense(store.store_to_voxels(store.read_store(spark, str(tmp_path / "none"))), a.shape)[:4, :3, :4] == 0).all()
    with pytest.raises(LookupError):
        store.describe(str(tmp_path))
    assert store.read_store(spark, str(tmp_path / "zstd"), region=[(0, 2), (0, 3), (0, 4)]).count() == 1


def test_spools_to_store_with_header(spark, tmp_path):
    f = np.random.default_rng(2).integers(0, 4096, (11, 4, 6))
    spool.write_spool(str(tmp_path / "a.fli.zst"), f, {"note": "x"})
    out = str(tmp_path / "volume")
    assert spool.spools_to_store(spark, str(tmp_path / "a.fli.zst"), out, (4, 4, 4)) and not spool.spools_to_store(spark, str(tmp_path / "a.fli.zst"), out)
    assert (dense(store.store_to_voxels(store.read_store(spark, out)), f.shape) == f * 16).all()
    import json

    assert json.load(open(f"{out}/header.json"))["note"] == "x" and open(f"{out}/header_raw.txt").read().endswith("{END}")


def test_zstd_content_size(tmp_path):
    import pyarrow as pa

    for n in (10, 300, 70_000):
        assert spool.content_size(pa.compress(bytes(n), codec="zstd", asbytes=True)[:18]) == n
    assert spool.content_size(b"plain bytes") is None and spool.content_size(b"") is None


def test_spool_writer_refuses_gaps(spark, tmp_path):
    d = spark.createDataFrame([(0, [1] * 8), (2, [1] * 8)], "frame long, data array<int>")
    with pytest.raises(Exception, match="consecutive"):
        spool.write_spools(d, str(tmp_path / "x"), 2, 4)


@pytest.mark.parametrize("kind", ["u1", "<u2", "<f4", "<i4"])
def test_tiff_pages(kind):
    a = np.random.default_rng(1).integers(0, 200, (3, 5, 7)).astype(kind)
    for deflate in (False, True):
        blob = images.encode_tiff(a, deflate)
        pages = images.tiff_pages(blob)
        assert len(pages) == 3 and all((images.tiff_page(blob, p) == a[i]).all() for i, p in enumerate(pages))
    big = b"MM\0*\0\0\0\x08" + b"\0\x05" + b"".join(np.array([t], ">u2").tobytes() + b"\0\x03\0\0\0\x01" + np.array([v, 0], ">u2").tobytes() for t, v in ((256, 2), (257, 1), (258, 16), (273, 74), (279, 4))) + b"\0\0\0\0" + b"\x01\x02\x03\x04"
    assert images.tiff_page(big, images.tiff_pages(big)[0]).tolist() == [[0x102, 0x304]]
    with pytest.raises(ValueError):
        images.tiff_pages(b"GIF89a__")


def mat_element(kind, raw):
    return np.array([kind, len(raw)], "<u4").tobytes() + raw + b"\0" * (-len(raw) % 8)


def mat_matrix(form, name, shape, body):
    return mat_element(14, mat_element(6, np.array([form, 0], "<u4").tobytes()) + mat_element(5, np.array(shape, "<i4").tobytes()) + mat_element(1, name) + body)


def test_mat_matrices(spark, tmp_path):
    import zlib

    a, b = np.arange(9.0).reshape(3, 3), np.eye(3) * 2
    number = lambda n, m: mat_matrix(6, n, m.shape, mat_element(9, m.astype("<f8").ravel(order="F").tobytes()))
    cell = mat_matrix(1, b"A2D", (1, 2), number(b"", a) + number(b"", b))
    struct_ = mat_matrix(2, b"S", (1, 1), np.array([4 << 16 | 5, 8], "<u4").tobytes() + mat_element(1, b"A2D\0\0\0\0\0") + number(b"", b))
    wide = number(b"W", np.arange(10.0).reshape(2, 5))
    packed = zlib.compress(wide)
    blob = b"MATLAB 5.0".ljust(124) + b"\0\x01IM" + cell + struct_ + np.array([15, len(packed)], "<u4").tobytes() + packed
    (tmp_path / "t.mat").write_bytes(blob)
    got_ = images.decode_mat(blob)
    assert [x.tolist() for x in images.affine_list(got_["A2D"])] == [a.tolist(), b.tolist()] and images.affine_list(got_["S"])[0].tolist() == b.tolist()
    assert got_["W"].tolist() == np.arange(10.0).reshape(2, 5).tolist()
    rows = images.read_matrices(spark, str(tmp_path)).toPandas()
    assert len(rows) == 37 and rows[(rows.name == "A2D") & (rows.m == 1)].v.sum() == 6


def test_pad_volume_corner(spark):
    out = arith.pad_volume(vox(spark, np.full((2, 2, 2), 8.0)), (2, 2, 2), 4)
    a = dense(out, (4, 4, 4))
    assert a[2, 2, 2] == 1.0 and a[3].max() == 0 and a[0, 0].tolist() == [8, 8, 4, 0]


def test_resize_taps_sum_to_one():
    for n, o, smooth in ((8, 3, True), (8, 3, False), (3, 8, True), (1, 4, True)):
        t = geometry.resize_taps(n, o, smooth)
        assert np.allclose(np.bincount(t[:, 0].astype(int), t[:, 2]), 1)


def test_graph_rounds_and_one_task_agree(spark):
    from lumenfold.plans.graph import connected_components

    r = np.random.default_rng(6)
    top = 1 << 62
    e = [(int(a) + top, int(b) + top) for a, b in r.integers(0, 400, (380, 2))]
    d = spark.createDataFrame(e, "a long, b long").repartition(5)
    rows = lambda x: sorted(map(tuple, x.collect()))
    assert rows(connected_components(d)) == rows(connected_components(d, small=0))
    with pytest.raises(RuntimeError):
        connected_components(d, small=0, max_rounds=1)


def test_released_tables_are_gone(spark):
    import os

    from lumenfold.plans.shared import materialize, release, written

    mark = written()
    first, second = materialize(spark.range(3), "one"), materialize(spark.range(4), "two")
    folder = lambda d: os.path.dirname(d.inputFiles()[0].removeprefix("file://"))
    a, b = folder(first), folder(second)
    assert release(spark, mark, last=False) == 1 and not os.path.exists(a) and second.count() == 4
    assert release(spark, mark) == 1 and not os.path.exists(b) and written() == mark


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lumenfold.plans.shared import shared_folder

    conf = {"spark.master": "spark://host:7077"}
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d))))
    conf["spark.checkpoint.dir"] = "hdfs:///x/"
    assert shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))) == "hdfs:///x"
