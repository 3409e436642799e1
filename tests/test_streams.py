"""Streams over restarts: deadlines of jobs, and frames of spools that grow."""

import datetime as dt

import numpy as np
import pytest


from lumenfold.sources import spool
from lumenfold.streaming import completion


def at(minutes):
    return dt.datetime(2024, 5, 1) + dt.timedelta(minutes=minutes)


def test_deadlines_over_restarts(spark, tmp_path):
    """Three runs of the same stream, each with new arrivals: state and timers go on where the last run stopped."""
    source, sink, log = (str(tmp_path / n) for n in ("in", "out", "log"))

    def arrive(*rows):
        spark.createDataFrame([(j, c, at(m)) for j, c, m in rows], "job string, chunk long, at timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("job string, chunk long, at timestamp").parquet(source)
        completion.drain(completion.watch(stream, 3, "60 minutes", "5 minutes"), sink, log)
        return sorted((r.job, r.status, r.arrived, r.missing, r.at) for r in spark.read.schema(completion.REPORTS).parquet(sink).collect())

    done = ("a", "complete", 3, 0, at(20))
    assert arrive(("a", 1, 0), ("a", 2, 10), ("a", 2, 11), ("a", 3, 20), ("b", 1, 0), ("c", 1, 30)) == [done]
    # b's last chunks come behind its deadline, c's second before; copies count once; a isn't reported again
    late = ("b", "late", 1, 2, at(60))
    assert arrive(("b", 2, 61), ("b", 3, 62), ("c", 2, 31), ("c", 2, 33), ("a", 3, 64), ("d", 5, 70)) == [done, late]
    # an arrival out of order completes c at its own time; d has time left
    assert arrive(("c", 3, 72), ("d", 6, 71)) == [done, late, ("c", "complete", 3, 0, at(72))]
    assert arrive(("e", 1, 500)) == [done, late, ("c", "complete", 3, 0, at(72)), ("d", "late", 2, 1, at(130))]
    assert arrive() == arrive()


def test_arrivals_of_files(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    for i in (3, 14):
        (folder / f"napari_chunk_{i:05d}.csv").write_text("x")
    run = lambda: completion.track(completion.arrivals(spark, str(folder), "*.csv").select("chunk"), str(tmp_path / "out"), str(tmp_path / "log"))
    run()
    (folder / "napari_chunk_00015.csv").write_text("y")
    run()
    assert sorted(r.chunk for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [3, 14, 15]


def test_growing_spools(spark, tmp_path):
    f = np.random.default_rng(7).integers(0, 4096, (20, 4, 6))
    folder, frame = tmp_path / "spools", 36
    folder.mkdir()
    head = spool.header_text({"x": 6, "y": 4, "first": 100})
    raw = spool.pack12(f.ravel())
    (folder / "a.fli").write_bytes(head + raw[: 7 * frame + 5])  # half a frame at the end

    def run():
        stream = spool.stream_spools(spark, str(folder), frames_at_once=4)
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r.frame, r.path.rpartition("/")[2], r.data) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    want = lambda k, name, low: [(low + i, name, (f[i].ravel() * 16).tolist()) for i in range(k)]
    assert run() == want(7, "a.fli", 100)
    (folder / "a.fli").write_bytes(head + raw)
    (folder / "b.fli").write_bytes(spool.header_text({"x": 6, "y": 4})[:10])  # a header that isn't whole yet
    assert run() == want(20, "a.fli", 100)
    (folder / "b.fli").write_bytes(spool.header_text({"x": 6, "y": 4}) + raw[: 3 * frame])
    assert run() == want(3, "b.fli", 0) + want(20, "a.fli", 100)
    assert run() == want(3, "b.fli", 0) + want(20, "a.fli", 100)


@pytest.mark.parametrize("n", [40, 96])
def test_planted_shifts(spark, n):
    from lumenfold.operators import align

    r = np.random.default_rng(n)
    pairs, planted = [], []
    for k in range(8):
        a = align.smooth(r.random((n + 20, n + 20)), 3.0)
        dz, dy = r.uniform(-2.5, 2.5, 2)
        m = align.smooth(r.random((n + 20, n + 20)), 3.0) * 0 + a
        z, y = np.arange(n) + 10 - dz, np.arange(n) + 10 - dy
        zi, yi = np.floor(z).astype(int), np.floor(y).astype(int)
        fz, fy = (z - zi)[:, None], (y - yi)[None]
        g = lambda i, j: m[np.ix_(zi + i, yi + j)]  # noqa: B023, E731
        moved = g(0, 0) * (1 - fz) * (1 - fy) + g(0, 1) * (1 - fz) * fy + g(1, 0) * fz * (1 - fy) + g(1, 1) * fz * fy
        moved = 3.0 - moved**2 if k % 2 else moved  # information doesn't mind another contrast
        pairs.append((k, n, n, a[10 : 10 + n, 10 : 10 + n].ravel().tolist(), moved.ravel().tolist()))
        planted.append((dz, dy))
    flat = [1.0] * (n * n)
    pairs += [(8, n, n, flat, flat), (9, n, n, None, flat)]
    df = spark.createDataFrame(pairs, "x long, height int, width int, fixed array<double>, moving array<double>")
    got = {q.x: q for q in align.align_translation(df, "x").collect()}
    for k, (dz, dy) in enumerate(planted):
        assert abs(got[k].dz - dz) < 0.1 and abs(got[k].dy - dy) < 0.1
    assert (got[8].dz, got[8].dy) == (0, 0) and got[9].dz is None


def test_information_against_its_definition():
    """The metric by loops over pixels and bins, and its gradient by differences."""
    from lumenfold.operators import align

    r = np.random.default_rng(1)
    fixed, moving = align.smooth(r.random((20, 22)), 1.5), align.smooth(r.random((20, 22)), 1.5)
    m = align.Metric(fixed, moving)
    shift = np.array([0.3, -0.7])
    spline = lambda u: (2 / 3 - u**2 + abs(u) ** 3 / 2) if abs(u) < 1 else (2 - abs(u)) ** 3 / 6 if abs(u) < 2 else 0.0
    joint, n = np.zeros((align.BINS, align.BINS)), 0
    for z in range(20):
        for y in range(22):
            u, v = z + 0.3, y - 0.7
            zi, yi = int(np.floor(u)), int(np.floor(v))
            if 0 <= zi < 19 and 0 <= yi < 21:
                a, b = u - zi, v - yi
                value = moving[zi, yi] * (1 - a) * (1 - b) + moving[zi, yi + 1] * (1 - a) * b + moving[zi + 1, yi] * a * (1 - b) + moving[zi + 1, yi + 1] * a * b
                place = 2 + (value - moving.min()) / ((moving.max() - moving.min()) / (align.BINS - 5))
                f = 2 + min(int((fixed[z, y] - fixed.min()) / (fixed.max() - fixed.min()) * (align.BINS - 4)), align.BINS - 5)
                for k in range(align.BINS):
                    joint[f, k] += spline(k - place)
                n += 1
    joint /= n
    pf, pm = joint.sum(axis=1, keepdims=True), joint.sum(axis=0, keepdims=True)
    on = joint > 0
    want = (joint[on] * np.log(joint[on] / (pf * pm)[on])).sum()
    got, gradient = m.at(shift)
    assert abs(got - want) < 1e-9
    # the image's slope is taken from its neighbours, so the gradient is close to the differences, not equal
    e = 1e-4
    differences = [(m.at(shift + e * np.eye(2)[i])[0] - m.at(shift - e * np.eye(2)[i])[0]) / (2 * e) for i in range(2)]
    assert gradient @ np.array(differences) > 0.8 * np.hypot(*gradient) * np.hypot(*differences)


def test_middle_planes_of_channels(spark):
    from lumenfold.operators import align

    r = np.random.default_rng(5)
    a = align.smooth(r.random((40, 40)), 2.5)
    rows = [(ch, x, 32, 32, a[4 - ch : 36 - ch, 4 + ch : 36 + ch].ravel().tolist()) for ch in (0, 1, 2) for x in range(50, 95)]
    got = align.channel_translations(spark.createDataFrame(rows, "ch int, x long, height int, width int, data array<double>"), 0, every=10, most=20).orderBy("ch").collect()
    assert [(g.ch, round(g.dz, 1), round(g.dy, 1), g.planes) for g in got] == [(1, 1.0, -1.0, 2), (2, 2.0, -2.0, 2)]
