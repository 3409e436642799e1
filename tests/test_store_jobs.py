"""Jobs on stored volumes against the voxel forms and plain NumPy, and what is made again after a job broke off."""

import itertools
import math

import numpy as np
import pytest

from lumenfold.operators import components, geometry
from lumenfold.plans import store_jobs
from lumenfold.sources import store


def save(path, a, chunks, dtype="<u2", codec="blosc"):
    """A store written directly, without Spark."""
    import os

    os.makedirs(path)
    about = store.description(a.shape, chunks, codec, dtype)
    s = store.Store(path, about)
    for place in itertools.product(*map(range, s.counts())):
        cut = tuple(slice(i * c, (i + 1) * c) for i, c in zip(place, chunks, strict=True))
        name, payload = s.put_chunk(place, a[cut])
        with open(f"{path}/{name}", "wb") as f:
            f.write(payload)
    store.finish(path, about)


def load(path):
    s = store.Store(path)
    return s.box([0] * len(s.shape), s.shape)


def voxels(spark, a, kind="long"):
    return spark.createDataFrame([(int(x), int(z), int(y), float(v)) for (x, z, y), v in np.ndenumerate(a)], f"x {kind}, z int, y int, v double")


def test_warped_store_equals_one_block(spark, tmp_path):
    a = np.random.default_rng(1).integers(0, 60000, (40, 9, 11))
    save(str(tmp_path / "a"), a, (16, 4, 8))
    t = np.radians(20)
    m = np.array([[np.cos(t), 0, -np.sin(t), 3.3], [0.1, 1.2, 0, -0.7], [np.sin(t), 0, np.cos(t), 1.1], [0, 0, 0, 1]])
    first = store_jobs.warp_store(spark, str(tmp_path / "a"), str(tmp_path / "b"), m, (16, 8, 8))
    low, high = geometry.output_bounds(m, a.shape)
    want = geometry.warp_cubic(a.astype(float), np.linalg.inv(m), low, tuple(high - low + 1))
    assert (first == low).all()
    got = load(str(tmp_path / "b"))
    assert got.shape == want.shape and (got == np.clip(np.rint(np.round(want, 6)), 0, 65535)).mean() > 0.9999
    assert np.abs(got - np.clip(want, 0, 65535)).max() < 0.5001


@pytest.mark.parametrize("to, smooth", [((13, 9, 22), True), ((40, 3, 11), True), ((7, 20, 5), False), ((1, 1, 1), True)])
def test_resized_store_equals_whole_taps(spark, tmp_path, to, smooth):
    a = np.random.default_rng(2).integers(0, 60000, (40, 9, 11))
    save(str(tmp_path / "a"), a, (16, 4, 8))
    store_jobs.resize_store(spark, str(tmp_path / "a"), str(tmp_path / "b"), to, smooth, (8, 4, 4))
    want = a.astype(float)
    for axis, (n, o) in enumerate(zip(a.shape, to, strict=True)):
        t = np.zeros((o, n))
        for i, j, w in geometry.resize_taps(n, o, smooth):
            t[int(i), int(j)] = w
        assert np.allclose(t.sum(axis=1), 1)
        want = np.moveaxis(np.tensordot(t, want, axes=(1, axis)), 0, axis)
    assert np.abs(load(str(tmp_path / "b")) - want).max() <= 0.5 + 1e-6


def plain_taps(n, o, anti_alias):
    """A filter matrix and a matrix that picks, multiplied."""
    mirror = lambda i: i if n == 1 else abs((i + n - 1) % (2 * n - 2) - (n - 1))
    smooth, sigma = np.zeros((n, n)), max(0.0, (n / o - 1) / 2) if anti_alias else 0.0
    reach = int(4 * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) if sigma else 1.0 for k in range(-reach, reach + 1)]
    for i, (k, x) in itertools.product(range(n), enumerate(w)):
        smooth[i, mirror(i + k - reach) if n > 1 else 0] += x / sum(w)
    pick = np.zeros((o, n))
    for i in range(o):
        at = (i + 0.5) * n / o - 0.5
        for j, x in ((math.floor(at), 1 - at + math.floor(at)), (math.floor(at) + 1, at - math.floor(at))):
            pick[i, mirror(j) if n > 1 else 0] += x
    return pick @ smooth


@pytest.mark.parametrize("n, o", [(1, 1), (1, 5), (2, 1), (5, 5), (9, 4), (30, 7), (7, 30), (64, 3)])
def test_banded_taps(n, o):
    for smooth in (False, True):
        want, got = plain_taps(n, o, smooth), np.zeros((o, n))
        for i, j, w in geometry.resize_taps(n, o, smooth):
            got[int(i), int(j)] += w
        assert np.allclose(got, want)
    # memory follows the outputs asked for, not the axis
    i, w = geometry.axis_taps(36_000, 12_000, True, 500, 628)
    assert i.shape == w.shape == (128, i.shape[1]) and i.shape[1] < 20


@pytest.mark.parametrize("n", [1, 2, 7, 300])
@pytest.mark.parametrize("dtype", ["<u2", "|u1", "<i2"])
def test_projections_of_a_store(spark, tmp_path, n, dtype):
    k = np.iinfo(np.dtype(dtype))
    a = np.random.default_rng(n).integers(k.min, k.max + 1, (n, 5, 7))
    a[:, 1, 1], a[:, 0, 0] = 3, np.arange(n) % 2 * 100  # ties, and middle values in different buckets
    save(str(tmp_path / "a"), a, (16, 4, 4), dtype)
    for axis, along in (("x", 0), ("z", 1), ("y", 2)):
        p = store_jobs.plane_pixels(store_jobs.project_store(spark, str(tmp_path / "a"), axis, tile=3)).toPandas()
        rest = [i for i in range(3) if i != along]
        assert len(p) == a.shape[rest[0]] * a.shape[rest[1]]
        at = tuple(p["xzy"[i]] for i in rest)
        for name, f in (("v_max", np.max), ("v_sum", np.sum), ("v_mean", np.mean), ("v_median", np.median)):
            assert np.allclose(p[name], f(a, axis=along)[at], rtol=1e-12), (axis, name)
    if n == 300:
        p = store_jobs.plane_pixels(store_jobs.project_store(spark, str(tmp_path / "a"), "x", 15, 180)).toPandas()
        assert np.array_equal(p.v_median, np.median(a[15:180], axis=0)[p.z, p.y])
    with pytest.raises(ValueError):
        store_jobs.project_store(spark, str(tmp_path / "a"), "x", n, n)


def flood(mask, kind):
    steps = geometry.neighbours(kind)
    out, todo = np.zeros(mask.shape, np.int64), []
    for at in zip(*np.nonzero(mask), strict=True):
        if out[at]:
            continue
        name, todo = int(np.ravel_multi_index(at, mask.shape)) + 1, [at]
        out[at] = name
        while todo:
            p = todo.pop()
            for o in steps:
                q = tuple(i + d for i, d in zip(p, o, strict=True))
                if all(0 <= i < n for i, n in zip(q, mask.shape, strict=True)) and mask[q] and not out[q]:
                    out[q] = name
                    todo.append(q)
    return out


@pytest.mark.parametrize("kind", [6, 18, 26])
def test_labels_of_a_store(spark, tmp_path, kind):
    r = np.random.default_rng(kind)
    a = (r.random((13, 10, 11)) < {6: 0.35, 18: 0.2, 26: 0.14}[kind]).astype(int) * 9
    a[2:12, 4, 4] = a[11, 4, 4:10] = 9  # an object through many chunks
    save(str(tmp_path / "a"), a, (4, 3, 5))
    store_jobs.label_store(spark, str(tmp_path / "a"), str(tmp_path / "b"), 5, kind)
    want = flood(a > 5, kind)
    assert (load(str(tmp_path / "b")) == want).all() and len(np.unique(want)) > 10
    voxel_form = components.label_components(voxels(spark, (a > 5).astype(int)), 10, 11, kind, 4).toPandas()
    assert (want[voxel_form.x, voxel_form.z, voxel_form.y] == voxel_form.label + 1).all()


def test_labels_without_objects_and_of_one_chunk(spark, tmp_path):
    save(str(tmp_path / "none"), np.zeros((5, 5, 5), int), (2, 2, 2))
    store_jobs.label_store(spark, str(tmp_path / "none"), str(tmp_path / "l0"), 0)
    assert not load(str(tmp_path / "l0")).any()
    save(str(tmp_path / "full"), np.ones((5, 5, 5), int), (2, 2, 2))
    store_jobs.label_store(spark, str(tmp_path / "full"), str(tmp_path / "l1"), 0)
    assert (load(str(tmp_path / "l1")) == 1).all()
    save(str(tmp_path / "one"), np.ones((5, 5, 5), int), (8, 8, 8))
    store_jobs.label_store(spark, str(tmp_path / "one"), str(tmp_path / "l2"), 0)
    assert (load(str(tmp_path / "l2")) == 1).all()


def test_shells_of_a_store(spark, tmp_path):
    r = np.random.default_rng(3)
    a = np.where(r.random((12, 9, 10)) < 0.01, r.integers(1, 90, (12, 9, 10)), 0)
    save(str(tmp_path / "a"), a, (4, 4, 5), "<i8")
    store_jobs.shell_store(spark, str(tmp_path / "a"), str(tmp_path / "s"), 3)
    label, layer = load(str(tmp_path / "s/label")), load(str(tmp_path / "s/layer"))
    on = np.stack(np.nonzero(a), axis=1)
    for at in np.ndindex(a.shape):
        d, lab = min(((int(((p - at) ** 2).sum()), int(a[tuple(p)])) for p in on), default=(99, 0))
        want = (lab, math.ceil(math.sqrt(d)) + 1) if d <= 9 else (0, 0)
        assert (label[at], layer[at]) == want
    rows = geometry.shells(voxels(spark, a).where("v > 0").withColumn("label", __import__("pyspark").sql.functions.col("v").cast("int")), 3, a.shape).toPandas()
    assert len(rows) == (layer > 0).sum() and (layer[rows.x, rows.z, rows.y] == rows.layer).all() and (label[rows.x, rows.z, rows.y] == rows.label).all()


def test_a_broken_job_goes_on(spark, tmp_path):
    a = np.random.default_rng(4).integers(0, 60000, (16, 8, 8))
    save(str(tmp_path / "a"), a, (4, 4, 4))
    src, about, out = store.Store(str(tmp_path / "a")), store.description(a.shape, (4, 4, 4)), str(tmp_path / "b")
    marks = tmp_path / "marks"
    marks.mkdir()

    def kernel(fail):
        def run(low, high, row):
            if fail and low[0] >= 8:
                raise RuntimeError("out of luck")
            (marks / f"{fail}-{row['place']}").touch()
            return src.box(low, high)

        return run

    with pytest.raises(Exception, match="out of luck"):
        store_jobs.run_job(spark, out, about, kernel(True), "copy", at_once=8)
    assert not store.exists(out)
    there = store.Store(out, about).present()
    assert there and store_jobs.pending(spark, out, about).count() == 16 - len(there)
    with pytest.raises(ValueError, match="another job"):
        store_jobs.run_job(spark, out, about, kernel(False), "something else")
    assert store_jobs.run_job(spark, out, about, kernel(False), "copy") == {"made": 16 - len(there), "kept": len(there)}
    redone = {p.name for p in marks.iterdir() if p.name.startswith("False")}
    assert len(redone) == 16 - len(there)
    assert (load(out) == a).all() and store_jobs.run_job(spark, out, about, kernel(True), "copy") == {"made": 0, "kept": 0}
    assert not (tmp_path / "b" / ".job").exists()


def test_portions_finish_a_store(spark, tmp_path):
    a = np.arange(4 * 4 * 4).reshape(4, 4, 4)
    save(str(tmp_path / "a"), a, (2, 2, 2))
    src, about, out = store.Store(str(tmp_path / "a")), store.description(a.shape, (2, 2, 2)), str(tmp_path / "b")
    for i in range(3):
        assert not store.exists(out)
        store_jobs.run_job(spark, out, about, lambda low, high, row: src.box(low, high), "copy", only=f"place % 3 = {i}")
    assert store.exists(out) and (load(out) == a).all()
    store_jobs.map_store(spark, out, str(tmp_path / "c"), lambda v: v * 2.0, "twice")
    assert (load(str(tmp_path / "c")) == 2 * a).all()


def test_released_tables_leave_the_catalog(spark):
    from lumenfold.plans import shared

    mark = shared.written()
    b = shared.Buckets(spark, "kept", "k", 4)
    b.add(spark.range(10).withColumnRenamed("id", "k"))
    assert b.read().count() == 10 and b.name in {t.name for t in spark.catalog.listTables()}
    shared.release(spark, mark)
    assert b.name not in {t.name for t in spark.catalog.listTables()}


def test_registration_of_a_store(spark, tmp_path):
    from lumenfold.operators.align import smooth
    from lumenfold.plans import registration

    r = np.random.default_rng(12)
    base = np.stack([smooth(r.random((24, 32)), 1.0) for _ in range(20)])
    base = ((base - base.min()) / (base.max() - base.min()) * 60_000).astype(int)
    planted = [(0, 0), (2, -3), (-1, 4), (5, 6)]
    a = np.stack([np.roll(base, (-dz, -dy), axis=(1, 2)) for dz, dy in planted])
    a[2, 5] = r.integers(0, 60_000, (24, 32))  # a plane that has nothing to do with its partner
    a[1:, 7] = a[0, 7] // 2  # and one that would tell a wrong shift, were it the only one
    save(str(tmp_path / "a"), a, (1, 8, 16, 16))
    scores = {s.x: s.score for s in registration.plane_scores(spark, str(tmp_path / "a"), 0, 2, 10).collect()}
    assert sorted(scores) == list(range(20))
    for x in range(20):
        h, _, _ = np.histogram2d(a[0, x].ravel(), a[2, x].ravel(), 10)
        e = lambda p: -(p[p > 0] / p.sum() * np.log(p[p > 0] / p.sum())).sum()
        assert scores[x] == pytest.approx((e(h.sum(axis=0)) + e(h.sum(axis=1))) / e(h), rel=1e-6)
    found = registration.register_store(spark, str(tmp_path / "a"), str(tmp_path / "b"), share=0.5, tile=32)
    assert found == dict(enumerate(planted))
    want = np.stack([np.roll(x, s, axis=(1, 2)) for x, s in zip(a, planted, strict=True)])
    assert (load(str(tmp_path / "b")) == want).all()


def test_mat_files_round_trip():
    from lumenfold.sources import images

    a = np.arange(12.0).reshape(3, 4)
    got = images.decode_mat(images.encode_mat({"plain": a, "cells": [np.eye(3), 2 * np.eye(3)], "row": np.ones(5)}))
    assert (got["plain"] == a).all() and [m.tolist() for m in images.affine_list(got["cells"])] == [np.eye(3).tolist(), (2 * np.eye(3)).tolist()]
    assert got["row"].shape == (1, 5)


def test_measured_objects_of_a_store(spark, tmp_path):
    from lumenfold.plans import detection

    r = np.random.default_rng(8)
    labels = np.where(r.random((9, 7, 8)) < 0.3, r.integers(1, 6, (9, 7, 8)), 0)
    values = r.integers(0, 60_000, (3, 9, 7, 8))
    save(str(tmp_path / "l"), labels, (4, 4, 4), "<i8")
    save(str(tmp_path / "v"), values, (1, 5, 7, 3))
    got = {m.label: m for m in detection.measure_store(spark, str(tmp_path / "l"), str(tmp_path / "v")).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    for k, m in got.items():
        at = np.nonzero(labels == k)
        assert m.n == len(at[0]) and m.layer == 1 and np.allclose([m.x, m.z, m.y], [a.mean() for a in at])
        assert np.allclose(m["values"], [v[at].mean() for v in values])
    assert detection.measure_store(spark, str(tmp_path / "l")).first()["values"] == []
    save(str(tmp_path / "other"), np.zeros((9, 7, 7), int), (4, 4, 4))
    with pytest.raises(ValueError, match="different sizes"):
        detection.measure_store(spark, str(tmp_path / "l"), str(tmp_path / "other"))
