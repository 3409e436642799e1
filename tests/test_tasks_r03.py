"""Small chunks and blocks don't make a task, a file opened or a call each."""

import math

import numpy as np
import pytest

from lumenfold.plans import store_jobs
from lumenfold.sources import store


def voxels(spark, a, names="x long, z int, y int, v int"):
    rows = zip(*np.indices(a.shape).reshape(a.ndim, -1).tolist(), a.ravel().tolist(), strict=True)
    return spark.createDataFrame(list(rows), names)


def test_small_chunks_share_tasks_and_reads(spark, tmp_path, monkeypatch):
    a = np.random.default_rng(1).integers(1, 99, (600, 4, 4))
    path = str(tmp_path / "a")
    blocks = store.to_chunks(voxels(spark, a), a.shape, (2, 2, 2))
    assert blocks.rdd.getNumPartitions() <= 16
    store.write_store(blocks, path, a.shape, (2, 2, 2))
    d = store.read_store(spark, path, beside={"again": path})
    assert d.rdd.getNumPartitions() <= 24  # of 1,200 chunks
    assert {(r.x, r.z, r.y): r.v for r in store.store_to_voxels(d).collect()} == dict(np.ndenumerate(a))
    assert d.where("data <> again").isEmpty()
    opened = []
    whole = store.Store.chunk
    monkeypatch.setattr(store.Store, "chunk", lambda self, place: opened.append(place) or whole(self, place))
    s = store.Store(path)
    for x in range(1, 19):
        assert (s.box([x - 1, 0, 0], [x + 2, 4, 4]) == a[x - 1 : x + 2]).all()
    assert len(opened) == len(set(opened)) == 40
    assert not s.__getstate__()["kept"]


def test_chunks_of_uneven_volumes(spark):
    r = np.random.default_rng(2)
    for shape, chunks in (((7, 5, 9), (3, 2, 4)), ((2, 7, 5, 9), (1, 3, 2, 4)), ((70, 40, 41), (32, 33, 40))):
        a = r.integers(0, 3, shape)
        d = voxels(spark, a, ("c int, " if len(shape) == 4 else "") + "x long, z int, y int, v int").where("v > 0")
        got = np.zeros(shape, int)
        for b in store.to_chunks(d, shape, chunks).collect():
            at = (*([b.c] if len(shape) == 4 else []), slice(b.x0, b.x0 + b.nx), slice(b.z0, b.z0 + b.nz), slice(b.y0, b.y0 + b.ny))
            assert not got[at].any()
            got[at] = np.array(b.data).reshape(b.nx, b.nz, b.ny)
        assert (got == a).all()
    with pytest.raises(Exception, match="beyond a volume"):
        store.to_chunks(voxels(spark, np.ones((3, 3, 3), int)), (3, 3, 2), (2, 2, 2)).count()


def test_shells_are_found_once_for_both_stores(spark, tmp_path):
    a = np.zeros((40, 4, 4), int)
    a[::9, 1, 2] = 5
    store.write_store(store.to_chunks(voxels(spark, a), a.shape, (8, 4, 4)), str(tmp_path / "a"), a.shape, (8, 4, 4), dtype="<i8")
    spark.sparkContext.setJobGroup("shells", "")
    store_jobs.shell_store(spark, str(tmp_path / "a"), str(tmp_path / "s"), 2)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("shells"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs <= 2 and all(store.exists(f"{tmp_path}/s/{n}") for n in ("label", "layer"))
    assert not any((tmp_path / "s" / n / ".job").exists() for n in ("label", "layer"))
    # a job that broke off after one of the stores makes the chunks that either lacks
    (tmp_path / "s/layer/.zarray").unlink()
    (tmp_path / "s/layer/2.0.0").unlink()
    before = store.Store(str(tmp_path / "s/label")).box([0, 0, 0], [40, 4, 4])
    store_jobs.shell_store(spark, str(tmp_path / "a"), str(tmp_path / "s"), 2)
    assert (store.Store(str(tmp_path / "s/label")).box([0, 0, 0], [40, 4, 4]) == before).all() and (tmp_path / "s/layer/2.0.0").exists()


def test_shells_take_few_calls_a_chunk(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(9)
    a = np.where(r.random((20, 7, 6)) < 0.03, r.integers(-2, 9, (20, 7, 6)), 0)
    a[9:, :, :] = 0
    store.write_store(store.to_chunks(voxels(spark, a), a.shape, (4, 4, 4)), str(tmp_path / "a"), a.shape, (4, 4, 4), dtype="<i4")
    kernels, calls, where = [], [], np.where
    monkeypatch.setattr(store_jobs, "run_job", lambda spark, out, about, kernel, *rest, **more: kernels.append(kernel))
    store_jobs.shell_store(spark, str(tmp_path / "a"), str(tmp_path / "s"), 3)
    monkeypatch.setattr(np, "where", lambda *v: calls.append(1) or where(*v))
    for low in np.ndindex(5, 2, 2):
        low = [4 * i for i in low]
        high = [min(i + 4, n) for i, n in zip(low, a.shape, strict=True)]
        del calls[:]
        label, layer = kernels[0](low, high, {})
        assert len(calls) < 20  # and not one for each of 123 places around
        for at in np.ndindex(label.shape):
            near = sorted((d, int(a[tuple(p)])) for p in np.argwhere(a > 0) if (d := int(((p - at - low) ** 2).sum())) <= 9)
            assert (label[at], layer[at]) == ((near[0][1], math.ceil(near[0][0] ** 0.5) + 1) if near else (0, 0))


def test_rows_of_small_chunks_share_tasks(spark, tmp_path):
    from lumenfold.plans import registration

    r = np.random.default_rng(4)
    base = r.integers(0, 60_000, (600, 8, 8))
    a = np.stack([np.roll(base, (-c, 2 * c), axis=(1, 2)) for c in range(2)])
    path = str(tmp_path / "a")
    store.write_store(store.to_chunks(voxels(spark, a, "c int, x long, z int, y int, v int"), a.shape, (1, 2, 4, 4)), path, a.shape, (1, 2, 4, 4))
    scores = registration.plane_scores(spark, path, 0, 1, 10)
    assert scores.rdd.getNumPartitions() <= 24 and scores.count() == 600  # of 300 rows of chunks
    planes = spark.range(5, 600, 3).withColumnRenamed("id", "x")
    shifts = registration.plane_shifts(spark, path, planes, 0, [1])
    assert 4 <= shifts.rdd.getNumPartitions() <= 24
    got = shifts.collect()
    assert sorted(s.x for s in got) == list(range(5, 600, 3)) and {(s.ch, s.dz, s.dy) for s in got} == {(1, 1, -2)}
    counts = r.integers(0, 3, (5, 40)) * np.array([[1], [1], [0], [7], [1]])
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    assert np.allclose(registration.entropy(counts), -(p * np.log(np.where(p > 0, p, 1))).sum(axis=1))


@pytest.mark.parametrize("kind", [6, 18, 26])
def test_blocks_in_a_row_are_labelled_by_one_call(spark, monkeypatch, kind):
    from lumenfold.operators import components

    a = (np.random.default_rng(kind).random((90, 7, 6)) < {6: 0.4, 18: 0.25, 26: 0.18}[kind]).astype(int)
    a[:, 3, 3] = 1  # an object through all of them
    want = store_jobs.label_block(a > 0, kind) - 1
    for most in (1, 200, 1 << 16):  # blocks of 4, 12 and all 90 planes a call
        monkeypatch.setattr(components, "PACK", most)
        got = components.label_components(voxels(spark, a), 7, 6, kind, 4).toPandas()
        assert len(got) == a.sum() and (want[got.x, got.z, got.y] == got.label).all()
    with pytest.raises(Exception, match="beyond planes"):
        components.label_components(voxels(spark, a), 7, 5, kind, 4).count()


def test_links_between_blocks_are_few(spark):
    """A full volume has 13 neighbour pairs a voxel; a part has one link to each voxel that it touches in another block."""
    from lumenfold.operators import components
    from lumenfold.plans import shared

    mark = shared.written()
    a = np.ones((400, 8, 8), int)
    labels = components.label_components(voxels(spark, a), 8, 8, 26, 4).select("label").distinct().collect()
    assert [r.label for r in labels] == [0]
    links = spark.read.parquet(shared._WRITTEN[mark]).where("outside IS NOT NULL")
    assert 0 < links.count() < a.size


def records_a_task(spark, group):
    """The most rows that a task of this job group has read from a shuffle."""
    store, tracker = spark._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
    most = 0
    for stage in {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}:
        if tracker.getStageInfo(stage) and tracker.getStageInfo(stage).numCompletedTasks:
            tasks = store.taskList(stage, 0, 10_000)
            most = max([most, *(tasks.apply(i).taskMetrics().get().shuffleReadMetrics().recordsRead() for i in range(tasks.size()))])
    return most


def test_large_components_stay_dealt_out(spark, monkeypatch):
    """A component through the whole volume doesn't bring its voxels to one task, whatever Spark broadcasts."""
    from lumenfold.operators import components, detect

    monkeypatch.setattr(components, "PACK", 1)  # blocks of 64 planes
    loose, strict = np.ones((400, 8, 8), int), np.zeros((400, 8, 8), int)
    loose[380] = 0  # the second component holds nothing and stays
    strict[:350:5, 3, 3] = 1
    pairs = [voxels(spark, a) for a in (loose, strict)]
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("merged", "")
        got = detect.split_merged(*pairs, 8, 8).collect()
    finally:
        spark.sparkContext.setJobGroup("other", "")
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {(x, 3, 3) for x in range(0, 350, 5)} | {tuple(p) for p in np.argwhere(loose).tolist() if p[0] > 380}
    assert {(r.x, r.z, r.y) for r in got} == want and len(got) == len(want)
    assert 0 < records_a_task(spark, "merged") < loose.sum() * 0.6


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_objects_of_any_masks(spark, monkeypatch, seed):
    """Strict voxels may lie outside the loose ones, and blocks cut both."""
    from lumenfold.operators import components, detect

    monkeypatch.setattr(components, "PACK", 1)
    r = np.random.default_rng(seed)
    loose, strict = (r.random((150, 7, 6)) < 0.1).astype(int), (r.random((150, 7, 6)) < 0.05).astype(int)
    loose[40:100, 2:4, 2:4] = 1
    strict |= loose & (r.random(loose.shape) < 0.3)
    a, b = store_jobs.label_block(loose > 0), store_jobs.label_block(strict > 0)
    held = [set(a[b == s].tolist()) for s in np.unique(b[b > 0])]
    inside = [h.pop() for h in held if len(h) == 1 and 0 not in h]
    merged = np.isin(a, [k for k in set(inside) if inside.count(k) >= 2])
    want = {tuple(p): 1 + int(strict[tuple(p)] > 0) for p in np.argwhere((loose > 0) & (~merged | (strict > 0))).tolist()}
    got = detect.split_merged(voxels(spark, loose), voxels(spark, strict), 7, 6, 2, core_split=True).collect()
    assert merged.any() and len(got) == len(want) and {(r.x, r.z, r.y): r.v for r in got} == want


def test_measures_of_small_chunks_share_tasks(spark, tmp_path):
    from lumenfold.plans import detection

    a = np.zeros((800, 4, 4), int)
    a[::7, 1, 2] = 5
    path = str(tmp_path / "a")
    store.write_store(store.to_chunks(voxels(spark, a), a.shape, (2, 4, 4)), path, a.shape, (2, 4, 4))
    spark.sparkContext.setJobGroup("measures", "")
    m = detection.measure_store(spark, path).collect()
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("measures") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("other", "")
    assert max(tasks) <= 24 and [(r.label, r.n) for r in m] == [(5, 115)]  # of 400 chunks


def test_small_planes_share_calls_and_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from lumenfold.sources import tiff

    a = np.random.default_rng(6).integers(0, 9, (600, 5, 7))
    blocks = store.to_chunks(voxels(spark, a), a.shape, (4, 3, 4))
    planes = tiff.blocks_to_planes(blocks, 5, 7)
    assert all((np.array(r.data).reshape(5, 7) == a[r.x]).all() for r in planes.collect()) and planes.count() == 600
    tiff.write_tiff_volumes(tiff.volume_files(planes, F.lit("v.tif"), 600), str(tmp_path), rows=5)
    t = tiff.read_tiff_volume(spark, str(tmp_path), group=64)
    assert t.rdd.getNumPartitions() <= 16  # of 600 groups
    assert all((np.array(r.data).reshape(5, 7) == a[r.page]).all() for r in t.collect()) and t.count() == 600
