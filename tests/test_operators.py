"""Operators against NumPy on tiny volumes, and properties that hold for any."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lumenfold.functions import names
from lumenfold.model import to_blocks, to_voxels
from lumenfold.operators import arith, chunks, components, detect, geometry, linalg, reduce, stitch, tables
from lumenfold.plans.graph import connected_components
from lumenfold.sources import spool
from lumenfold.sources import tables as sinks


def vox(spark, a):
    i = np.indices(a.shape).reshape(3, -1)
    return spark.createDataFrame(pd.DataFrame({"x": i[0].astype("int64"), "z": i[1].astype("int32"), "y": i[2].astype("int32"), "v": a.ravel()}))


def dense(df, shape, col="v"):
    p = df.toPandas()
    out = np.zeros(shape)
    out[p.x, p.z, p.y] = p[col]
    return out


@pytest.fixture(scope="module")
def cube():
    return np.random.default_rng(3).integers(0, 4096, (6, 5, 7)) * 16


def test_unpack_known_bytes():
    assert spool.unpack12_bytes(bytes([0x12, 0x34, 0x56]), False).tolist() == [1042, 1379]
    assert spool.unpack12_bytes(bytes([0x12, 0x34, 0x56])).tolist() == [16672, 22064]
    p = np.random.default_rng(1).integers(0, 4096, 240)
    assert (spool.unpack12_bytes(spool.pack12(p), False) == p).all()


def test_header_and_whole_frames():
    h = spool.parse_header(b"x = 4\ny = 2\nbad line\nname = 'a'\n{END}rest")
    assert (h["x"], h["y"], h["name"], h["header_length"]) == (4, 2, "a", 37)
    with pytest.raises(ValueError):
        spool.parse_header(b"x = 4")


@pytest.mark.parametrize("name", ["a.fli", "b.fli.zst"])
def test_spool_source(spark, tmp_path, name):
    f = np.random.default_rng(2).integers(0, 4096, (11, 4, 6))
    spool.write_spool(str(tmp_path / name), f)
    got = spool.frames_to_voxels(spool.read_spools(spark, str(tmp_path / name), frames_at_once=4, scale=False))
    assert (dense(got, f.shape) == f).all()


def test_spool_with_an_extra_byte_fails(spark, tmp_path):
    spool.write_spool(str(tmp_path / "a.fli"), np.zeros((2, 2, 4), int))
    with open(tmp_path / "a.fli", "ab") as f:
        f.write(b"x")
    with pytest.raises(PySparkException):
        spool.read_spools(spark, str(tmp_path / "a.fli")).count()


def test_median_subtract_clip(spark):
    v = vox(spark, np.array([10, 20, 30, 40, 1000]).reshape(5, 1, 1))
    d = arith.subtract_background(v, reduce.median_mask(v))
    assert sorted(r.v for r in d.collect()) == [-20, -10, 0, 10, 970]
    assert sorted(r.v for r in d.select(arith.clip16(F.col("v")).alias("v")).collect()) == [0, 0, 0, 10, 970]


def test_quadrants(spark):
    v = vox(spark, np.array([[10 * z + y for y in range(4)] for z in range(4)]).reshape(1, 4, 4))
    first = lambda order: {r.ch: r.v for r in arith.split_quadrants(v, 2, 2, 4, 4, order).where("z = 0 AND y = 0").collect()}
    assert first("volume") == {1: 0, 2: 20, 3: 2, 4: 22}
    assert first("pattern") == {1: 0, 3: 20, 2: 2, 4: 22}


def test_roll_shift_rotate_crop(spark, cube):
    v = vox(spark, cube)
    s = cube.shape
    assert (dense(arith.roll(v, 2, -3, 5, 7), s) == np.roll(cube, (2, -3), (1, 2))).all()
    assert (dense(arith.roll(arith.roll(v, 2, -3, 5, 7), -2, 3, 5, 7), s) == cube).all()
    assert (dense(arith.rot180(v, 5, 7), s) == cube[:, ::-1, ::-1]).all()
    want = np.zeros(s)
    want[:, 1:, :-2] = cube[:, :-1, 2:]
    assert (dense(arith.shift_zero(v, 1, -2, 5, 7), s) == want).all()
    assert (dense(arith.shift_zero(v, 0, 1, 5, 7), s)[:, :, 1:] == cube[:, :, :-1]).all()
    assert (dense(arith.crop(v, 5, 7, 1, 1, 2, 0), (6, 3, 5)) == cube[:, 1:4, 2:]).all()


def test_blocks_keep_every_voxel(spark, cube):
    for n in (2, 3, 8):
        b = to_blocks(vox(spark, cube), n, n, n)
        assert (dense(to_voxels(b, n, n, n), cube.shape) == cube).all()


def test_minmax_and_constant(spark, cube):
    lo, hi = cube.min(), cube.max()
    assert (dense(arith.minmax16(vox(spark, cube)), cube.shape) == np.floor((cube - lo) * 65535.0 / (hi - lo))).all()
    assert dense(arith.minmax16(vox(spark, np.full((2, 2, 2), 9))), (2, 2, 2)).max() == 0


def test_threshold_of_constant_patch(spark):
    z = vox(spark, np.zeros((1, 2, 2)))
    assert {r.mask for r in arith.threshold_mask(z, 0.999).collect()} == {0}
    assert {r.mask for r in arith.threshold_mask(z, 0.999, replicate_constant=True).collect()} == {255}


def test_projections(spark, cube):
    p = reduce.project(vox(spark, cube), "z", "y").toPandas()
    assert (p.v_max == cube.max(axis=0)[p.z, p.y]).all() and (p.v_median == np.median(cube, axis=0)[p.z, p.y]).all()


def test_unmix_and_affine(spark):
    m = [[2.0, 1.0], [0.5, 3.0]]
    got = linalg.unmix(spark.createDataFrame([(1, 4.0, 7.0)], "x int, a double, b double"), m, ["a", "b"]).first()
    assert np.allclose([got.u_a, got.u_b], np.linalg.inv(m).T @ [4, 7])
    nn = linalg.unmix_nonnegative(spark.createDataFrame([(1, 4.0, 7.0), (2, -5.0, 1.0)], "x int, a double, b double"), m, ["a", "b"]).toPandas()
    assert np.allclose(nn.iloc[0, 1:].astype(float), np.linalg.inv(np.array(m).T) @ [4, 7], atol=1e-6) and (nn[["u_a", "u_b"]] >= 0).all().all()
    assert np.allclose(linalg.compose_affine(), np.eye(4))
    lo, hi = geometry.output_bounds(np.eye(4), (3, 4, 5))
    assert lo.tolist() == [0, 0, 0] and hi.tolist() == [2, 3, 4]


def test_warps_of_identity_and_shift(spark, cube):
    v = vox(spark, cube.astype(float))
    assert np.allclose(dense(geometry.warp_bilinear(v, [[1, 0, 0], [0, 1, 0]], 5, 7), cube.shape), cube)
    want = np.zeros(cube.shape)
    want[:, :, 1:] = cube[:, :, :-1]
    assert np.allclose(dense(geometry.warp_bilinear(v, [[1, 0, 1], [0, 1, 0]], 5, 7), cube.shape), want)
    for block in (3, 64):
        assert np.allclose(dense(geometry.warp_blocks(v, np.eye(4), cube.shape, block), cube.shape), cube, atol=1e-6)
    c = np.random.default_rng(0).random((5, 6, 7))
    assert np.allclose(geometry.warp_cubic(c, np.eye(4), np.zeros(3), c.shape), c)


def test_cubic_blocks_agree(spark):
    a = np.random.default_rng(4).random((20, 8, 8))
    m = linalg.compose_affine(rotation=5.0, deskew=-7.0)
    parts = [geometry.warp_blocks(vox(spark, a), m, a.shape, b, halo=12).toPandas().sort_values(["x", "z", "y"]).reset_index(drop=True) for b in (8, 64)]
    both = parts[0].merge(parts[1], on=["x", "z", "y"], how="outer").fillna(0)
    assert np.allclose(both.v_x, both.v_y, atol=1e-5)


def test_resize(spark, cube):
    v = vox(spark, cube.astype(float))
    assert (dense(geometry.resize_nearest(v, 5, 7, 5, 7), cube.shape) == cube).all()
    assert np.allclose(dense(geometry.resize_linear(v, 5, 7, 5, 7), cube.shape), cube)


def brute_components(on, offsets):
    lab, seen = {}, set()
    pts = {tuple(p) for p in np.argwhere(on)}
    for p in sorted(pts):
        if p in seen:
            continue
        todo, own = [p], []
        seen.add(p)
        while todo:
            q = todo.pop()
            own.append(q)
            for o in offsets:
                r = (q[0] + o[0], q[1] + o[1], q[2] + o[2])
                if r in pts and r not in seen:
                    seen.add(r)
                    todo.append(r)
        for q in own:
            lab[q] = min(own)
    return lab


@pytest.mark.parametrize(("kind", "block"), [(26, 3), (6, 4), (26, 64)])
def test_components_any_block(spark, kind, block):
    on = (np.random.default_rng(7).random((8, 7, 6)) > 0.8).astype(int)
    want = brute_components(on, geometry.neighbours(kind))
    got = components.label_components(vox(spark, on), 7, 6, kind, block).collect()
    assert {(r.x, r.z, r.y): r.label for r in got} == {p: (q[0] * 7 + q[1]) * 6 + q[2] for p, q in want.items()}


def test_corner_contact(spark):
    a = np.zeros((2, 2, 2), int)
    a[0, 0, 0] = a[1, 1, 1] = 1
    n = lambda k: components.label_components(vox(spark, a), 2, 2, k).select("label").distinct().count()
    assert (n(26), n(6)) == (1, 2)


def test_components_by_value_and_empty(spark):
    a = np.array([[[1, 2, 2]]])
    assert components.label_components(vox(spark, a), 1, 3, by_value=True).select("label").distinct().count() == 2
    assert components.label_components(vox(spark, a * 0), 1, 3).count() == 0


def test_graph_paths(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    assert {r.component for r in connected_components(e).collect()} == {0, 100}


def test_shells_of_one_voxel(spark):
    s = geometry.shells(spark.createDataFrame([(1, 10, 10, 10)], "label int, x int, z int, y int"))
    assert {r.layer: r["count"] for r in s.groupBy("layer").count().collect()} == {1: 1, 2: 6, 3: 26, 4: 90}
    assert s.count() == s.select("x", "z", "y").distinct().count()


def test_dilate(spark):
    one = spark.createDataFrame([(5, 5, 5)], "x int, z int, y int")
    assert [geometry.dilate(one, k).count() for k in (6, 18, 26)] == [7, 19, 27]
    assert geometry.dilate(one, 26, 2, ring=True).count() == 124


def test_dbscan_line(spark):
    p = spark.createDataFrame([(i, float(x), 0.0, 0.0) for i, x in enumerate((0, 2, 4, 7))], "id long, x double, z double, y double")
    assert sorted((r.n, r.x) for r in components.cluster_centres(components.clusters(p, 2.0)).collect()) == [(1, 7.0), (3, 2.0)]


def test_box_mean_clips(spark, cube):
    p = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 3.5, 2.0, 3.0), (3, 99.0, 99.0, 99.0)], "id long, px double, pz double, py double")
    got = {r.id: (r["mean"], r.n) for r in components.box_mean(p, vox(spark, cube), (4, 2, 2), cube.shape, 2).collect()}
    assert got[1] == (cube[0:4, 0:2, 0:2].mean(), 16) and got[3] == (0.0, 0)
    assert np.isclose(got[2][0], cube[2:6, 1:3, 2:4].mean())


def test_dedupe_strategies(spark):
    d = spark.createDataFrame([(1, 1, 1, 5, 0, 0), (1, 1, 1, 9, 1, 0), (2, 2, 2, 3, 0, 1)], "axis_0 int, axis_1 int, axis_2 int, vol_l1 int, chunk int, row int")
    got = lambda s: sorted(float(r.vol_l1) for r in tables.combine_spectra(d, s).collect())
    assert (got("first"), got("max_vol_l1"), got("mean")) == ([3, 5], [3, 9], [3, 7])
    once = tables.keep_first(d, ["axis_0"], ["chunk", "row"])
    assert sorted(once.collect()) == sorted(tables.keep_first(once, ["axis_0"], ["chunk", "row"]).collect())
    assert tables.keep_largest(d.drop("vol_l1"), ["axis_0"], "vol_l1", ["chunk", "row"]).count() == 2


def test_offsets_over_an_empty_chunk(spark):
    d = spark.createDataFrame([(0, 3), (2, 4)], "chunk int, label int")
    assert {(r.chunk, r.label) for r in tables.offset_labels(d).collect()} == {(0, 3), (2, 7)}


def test_slab_pads_and_starts(spark):
    s = spark.createDataFrame([(z, 100) for z in range(3)], "scan_z int, width int")
    assert sorted((r.scan_z, r.left_pad, r.total) for r in stitch.slab_pads(s).collect()) == [(0, 48, 148), (1, 24, 148), (2, 0, 148)]
    assert sorted((r.scan_z, r.left_pad) for r in stitch.slab_pads(s, 24).collect()) == [(0, 0), (1, 24), (2, 48)]


@pytest.mark.parametrize("cut", range(5))
def test_crop_sweep_keeps_widths(spark, cube, cut):
    v = arith.crop(vox(spark, cube), 5, 7, right=cut).withColumn("scan_z", F.lit(1)).withColumn("scan_y", (F.col("x") % 2).cast("int"))
    t = spark.createDataFrame([(1, 0, 7 - cut), (1, 1, 7 - cut)], "scan_z int, scan_y int, width int")
    assert stitch.stitch(v, t).agg(F.max("y")).first()[0] == 2 * (7 - cut) - 1


def test_missing_tiles(spark):
    grid = spark.createDataFrame([(y, z) for y in (1, 2) for z in (1, 2)], "y int, z int")
    have = spark.createDataFrame([(1, 1), (2, 2)], "y int, z int")
    assert sorted(tuple(r) for r in tables.missing_tiles(grid, have, ["y", "z"]).collect()) == [(1, 2), (2, 1)]


def test_chunk_grid_covers_once(spark):
    g = chunks.chunk_grid(spark, (5, 7, 6), 3)
    seen = g.selectExpr("explode(sequence(z0, z1)) z", "*").where("z < z1").selectExpr("z", "explode(sequence(y0, y1)) y", "y1", "x0", "x1").where("y < y1").selectExpr("z", "y", "explode(sequence(x0, x1)) x", "x1").where("x < x1")
    assert seen.count() == seen.select("x", "y", "z").distinct().count() == 210
    assert chunks.chunk_grid(spark, (1700, 1, 1), 850).count() == 3
    assert chunks.chunk_grid(spark, (80 * 850, 1, 1), 850).where("z0 = 66300").count() == 1


def test_rounding_and_units(spark):
    d = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    assert [r[0] for r in d.select(arith.round16(F.col("v"))).collect()] == [0, 2, 2]
    p = spark.createDataFrame([(2.0, 3.0)], "x double, y double")
    assert arith.to_units(arith.to_units(p, {"x": 1.34}), {"x": 1.34}, back=True).first().x == pytest.approx(2.0)


def test_names(spark):
    d = spark.createDataFrame([("/a-z01-y007-Exc-488nm_272.fli.zst",), ("/corrections05/x_darkFrames_561 nm.fli",)], "p string")
    p = F.col("p")
    r = d.select(names.infer_axis(p, "z").alias("z"), names.infer_laser(p).alias("laser"), names.is_dark(p).alias("dark"), names.is_compressed(p).alias("zst")).collect()
    assert [tuple(x) for x in r] == [("01", "488", False, True), ("05", "561", True, False)]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("nothing.txt",)], "p string").select(names.infer_axis(p, "z")).collect()


def test_containment(spark):
    loose = vox(spark, np.ones((1, 1, 9), int)).select("x", "z", "y", F.lit(1).alias("label"))
    strict = loose.where("y % 2 = 0").select("x", "z", "y", F.col("y").alias("label"))
    assert [tuple(r) for r in components.containing(loose, strict).collect()] == [(1, 5)]


def test_two_thresholds_and_core_flag(spark):
    loose = np.ones((1, 1, 9), int)
    strict = (np.arange(9) % 3 == 1).astype(int).reshape(1, 1, 9)
    out = detect.split_merged(vox(spark, loose), vox(spark, strict), 1, 9)
    assert sorted(r.y for r in out.collect()) == [1, 4, 7]
    far = detect.split_merged(vox(spark, loose), vox(spark, strict), 1, 9, least=9, core_split=True)
    assert {r.v for r in far.collect()} == {1, 2}


def test_scorer_blocks_and_empty_patch(spark):
    s = detect.score_patches(vox(spark, np.zeros((4, 4, 4))), detect.IntensityScorer(), 2)
    assert detect.mask_of(s, 0.5).agg(F.sum("v")).first()[0] == 0 and s.count() == 64


def test_phase_shift_inverts_roll(spark, cube):
    v = vox(spark, cube.astype(float))
    p = v.withColumnRenamed("v", "a").join(arith.roll(v, 1, 2, 5, 7).withColumnRenamed("v", "b"), ["x", "z", "y"])
    assert {(r.dz, r.dy) for r in geometry.phase_shift(p, 5, 7).collect()} == {(-1, -2)}


def test_histogram_match_of_itself(spark, cube):
    v = vox(spark, cube.astype(float))
    assert np.allclose(dense(geometry.match_histogram(v, v, "x"), cube.shape), cube)
    e = dense(geometry.equalise(v, 5, 7, 3), cube.shape)
    assert e.min() >= 0 and e.max() <= 1 + 1e-9


def test_spectral_table(spark):
    layers = geometry.shells(spark.createDataFrame([(1, 2, 2, 2)], "label int, x int, z int, y int"), 3, (5, 5, 5))
    ch = vox(spark, np.ones((5, 5, 5), int)).crossJoin(spark.range(1, 6).selectExpr("cast(id as int) ch")).selectExpr("x", "z", "y", "ch", "v * ch v")
    r = tables.spectral_table(layers, ch).first()
    assert len(r) == 28 and (r.vol_l1, r.vol_l2, r.vol_l3) == (1, 6, 26) and r.ch3_l2 == 3.0


def test_sinks(spark, tmp_path, cube):
    v = vox(spark, cube).withColumn("ch", F.lit(2))
    sinks.write_volume(to_blocks(v, 4, 4, 4, "ch"), str(tmp_path / "v"), "ch")
    sinks.write_volume(to_blocks(v.where("x < 0"), 4, 4, 4, "ch"), str(tmp_path / "v"), "ch")  # resumed: the first stays
    assert (dense(to_voxels(spark.read.parquet(str(tmp_path / "v")), 4, 4, 4), cube.shape) == cube).all()
    sinks.write_planes(v, str(tmp_path / "p"), "ch", "z")
    assert spark.read.parquet(str(tmp_path / "p")).where("z = 3").count() == 42
    p = spark.createDataFrame([(1.0, 2.0, 3.0)], sinks.POINTS)
    sinks.write_points(p, str(tmp_path / "napari_chunk_00007.csv"))
    got = sinks.read_chunk_points(spark, str(tmp_path / "napari_chunk_00007.csv")).first()
    assert (got.axis_0, got.axis_2) == (1.0, 3.0)


def test_stream_drains_once(spark, tmp_path):
    from lumenfold.streaming.completion import is_complete, track

    for k in range(2):
        spark.range(5).selectExpr("id % 4 chunk").write.mode("append").parquet(str(tmp_path / "in"))
        track(spark.readStream.schema("chunk long").parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "log"))
    done = spark.read.parquet(str(tmp_path / "out"))
    assert done.count() == 4
    assert is_complete(spark.range(4).withColumnRenamed("id", "chunk"), done) and not is_complete(spark.range(5).withColumnRenamed("id", "chunk"), done)


def test_entry_without_llm():
    import __spark_entry__ as e

    assert {"correct_and_project", "shells"} <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_half_offsets():
    for k in (6, 18, 26):
        h = components.half_offsets(k)
        assert len(h) == k // 2 and not {tuple(-c for c in o) for o in h} & set(h)
    assert len(list(itertools.product(range(2), repeat=3))) == 8
