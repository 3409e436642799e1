"""Work that must not grow with the square of the input."""

import numpy as np
import pandas as pd
import pyarrow as pa

from lumenfold.operators import catalog, components, geometry, linalg
from lumenfold.sources import spool, store
from lumenfold.streaming.completion import Deadline


def test_warp_of_a_long_volume(spark):
    """A turned volume of many frames spans a box of which it fills a thin diagonal: only blocks that it touches are gone through."""
    n = 400_000
    m = linalg.compose_affine(rotation=5.0, deskew=-7.0, tx=4.5)
    v = spark.createDataFrame([(x, z, y, 1000 + z) for x in range(n - 10, n) for z in range(8) for y in range(8)], "x long, z int, y int, v int")
    parts = []
    for block in (16, 64):
        d = geometry.warp_blocks(v, m, (n, 8, 8), block).where("abs(v) > 0.01").toPandas()
        parts.append({(r.x, r.z, r.y): r.v for r in d.itertuples()})
    assert len(parts[0]) > 400
    assert all(abs(parts[0].get(k, 0.0) - parts[1].get(k, 0.0)) < 0.05 for k in {*parts[0], *parts[1]})
    assert np.isclose(max(parts[0].values()), 1007, atol=150)


def test_clusters_of_crowded_points(spark):
    """Copies at a place are one site: 200,000 points at four places don't make a link a pair."""
    p = spark.range(200_000).selectExpr("id", "double(id % 4 * 2 + if(id % 4 > 1, 5, 0)) AS x", "0D AS z")
    whole = p.selectExpr("*", "if(id < 4, null, 1D) AS y")
    got = components.clusters(whole, 2.0).groupBy("cluster").count().collect()
    assert {(r.cluster, r["count"]) for r in got} == {(k, 1) for k in range(4)} | {(4, 99_998), (6, 99_998)}


def test_clusters_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    for axes, n in ((("x", "z", "y"), 400), (("x", "y"), 150)):
        at = np.concatenate([rng.uniform(-15, 15, (n, len(axes))), np.round(rng.uniform(-15, 15, (n, len(axes))) * 2) / 2])
        rows = [(int(i), *map(float, a)) for i, a in enumerate(at)]
        label = np.arange(len(at))
        near = ((at[:, None] - at[None]) ** 2).sum(axis=2) <= 4.0
        for _ in range(len(at)):
            new = np.where(near, label[None], len(at)).min(axis=1)
            if (new == label).all():
                break
            label = new
        got = components.clusters(spark.createDataFrame(rows, f"id long, {', '.join(f'{c} double' for c in axes)}"), 2.0, axes).collect()
        assert {r.id: r.cluster for r in got} == dict(enumerate(label.tolist())) and 1 < len(set(label.tolist())) < len(at)


def test_ingest_is_one_job_for_all_spools(spark, tmp_path):
    """Volumes of spools of two frame sizes are those that each spool gives by itself, and more spools don't take more jobs."""
    rng = np.random.default_rng(4)
    jobs = []
    for many in (2, 5):
        folder = tmp_path / str(many)
        folder.mkdir()
        for i in range(many):
            shape = (5 + i, 4, 6 if i % 2 else 8)
            spool.write_spool(str(folder / f"s-{i * 3:02d}.fli{'.zst' if i == 1 else ''}"), rng.integers(0, 4096, shape), {"first": i * 3})
        spark.sparkContext.setJobGroup(f"ingest {many}", "")
        names = spool.ingest(spark, str(folder), f"{folder}/out", (4, 3, 4))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"ingest {many}")))
        spark.sparkContext.setJobGroup("other", "")
        assert names == [f"s-{i * 3:02d}" for i in range(many)] and spool.ingest(spark, str(folder), f"{folder}/out", (4, 3, 4)) == names
    assert jobs[1] <= jobs[0] + 1
    boxes = [(f"{folder}/out/{n}", int(n.split("-")[1])) for n in names]
    got = {}
    for r in store.store_to_voxels(store.read_stores(spark, boxes)).collect():
        got.setdefault(r.path.rpartition("/")[2], {})[r.x, r.z, r.y] = r.v
    for i, n in enumerate(names):
        spool.spools_to_store(spark, str(folder / f"{n}.fli{'.zst' if i == 1 else ''}"), f"{folder}/one/{n}", (4, 3, 4))
        want = {(r.x, r.z, r.y): r.v for r in store.store_to_voxels(store.read_store(spark, f"{folder}/one/{n}")).collect() if r.x >= i * 3}
        assert got[n] == want and len(want) == (5 + i) * 4 * (6 if i % 2 else 8)
        for side in (".zarray", "header.json", "header_raw.txt", "README.txt"):
            assert (folder / "out" / n / side).read_bytes() == (folder / "one" / n / side).read_bytes()


def test_enlarged_frames_come_in_small_batches():
    """10,000 frames a batch, as Spark gives them, don't become batches of 10,000 enlarged ones."""
    e = np.random.default_rng(5).random((1000, 64))
    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(1000)), pa.array(list(e), pa.list_(pa.float64()))], ["x", "e"])
    got = list(catalog.enlarged([whole, whole.slice(0, 0)]))
    assert max(b.num_rows for b in got) <= 256 and sum(b.num_rows for b in got) == 4000
    first = {x: v for b in got if b.num_rows and b.column("ch")[0].as_py() == 0 for x, v in zip(b.column("x").to_pylist(), b.column("data"), strict=True)}
    # place 2 of each five is the middle of a pixel
    assert np.allclose(np.array(first[999].as_py()).reshape(40, 40)[2::5, 2::5], e[999].reshape(8, 8))


def test_deadline_reads_and_writes_its_state_once_a_call():
    """Every access is a message to the state store: their number doesn't grow with a job's chunks."""
    calls = []

    class State:
        def __init__(self):
            self.kept = {}

        def __getattr__(self, name):
            def run(*a):
                calls.append(name)
                if name in ("update", "updateValue"):
                    self.kept[a[0] if len(a) > 1 else 0] = a[-1]
                return {"exists": 0 in self.kept, "get": self.kept.get(0), "containsKey": a[:1] and a[0] in self.kept, "getValue": a and self.kept.get(a[0]), "values": list(self.kept.values())}.get(name)

            return run

    class Handle:
        def __getattr__(self, name):
            return (lambda *a: State()) if name.startswith("get") else lambda *a: calls.append(name)

    counts = []
    for n in (2, 200):
        p = Deadline(1000, 10_000)
        p.init(Handle())
        for part in (range(n), range(n, 2 * n)):
            calls.clear()
            assert not list(p.handleInputRows(("a",), iter([pd.DataFrame({"chunk": list(part), "at_ms": [100 + k for k in part]})]), None))
        counts.append(len(calls))
        late = pd.concat(p.handleExpiredTimer(("a",), None, type("E", (), {"getExpiryTimeInMs": lambda self: 10_100})()))
        assert late.arrived.tolist() == [2 * n] and late.missing.tolist() == [1000 - 2 * n]
    assert counts[0] == counts[1] <= 4
