import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.operators import events as E
from featherline.operators import explore as V
from featherline.operators import profile as P
from featherline.operators import similarity as N
from featherline.operators import stats as T
from featherline.operators import store as R
from featherline.operators.segment import bar_crops, crop_tracks, tiles
from featherline.sources import records, sinks


def test_records(spark, tmp_path):
    a = tmp_path / "A - B"
    a.mkdir()
    (a / "A - B_0.INFO").write_text('{"bpm": 140, "flag": true, "none": null, "genres": ["x", "y"], "scale": "minor"}')
    (a / "A - B_0_bass.INFO").write_text('{"bpm": 999}')
    (a / "bad.INFO").write_text("{")
    r = records.info_records(spark, str(tmp_path))
    assert r.filter("bad").count() == 1
    full = records.full_mix_only(r)
    e = {x.name: x for x in records.entries(full).collect()}
    assert e["bpm"].number == 140 and e["flag"].kind == "flag" and e["flag"].number is None
    assert e["none"].is_null and e["genres"].number == 2 and e["scale"].text == "minor" and {x.key for x in e.values()} == {"A - B_0"}


def test_event_lists_and_arrays(spark, tmp_path):
    d = tmp_path / "t"
    d.mkdir()
    (d / "t.ONSETS").write_text("0.5\nbad\n1.25\n")
    (d / "u.ONSETS").write_text("")
    assert [(r.seq, r.t) for r in records.event_lists(spark, str(tmp_path), "ONSETS").collect()] == [(0, 0.5), (1, 1.25)]
    np.save(d / "z.npy", np.arange(6, dtype=np.float16).reshape(2, 3))
    np.savez(d / "ts.npz", rms=np.ones(4))
    (d / "x.npy").write_bytes(b"no")
    got = {(r.path.rsplit("/", 1)[1], r.field): r for r in records.arrays(spark, str(tmp_path)).collect()}
    assert got["z.npy", ""].shape == [2, 3] and got["z.npy", ""]["values"] == [0, 1, 2, 3, 4, 5] and got["ts.npz", "rms"].shape == [4] and got["x.npy", None].error
    f = records.frames(records.arrays(spark, str(tmp_path)).filter("field = ''"), ["path"]).orderBy("frame").collect()
    assert [r.x for r in f] == [[0, 3], [1, 4], [2, 5]]


def test_versions_csv_and_events(spark, tmp_path):
    at = str(tmp_path / "v")
    assert sinks.append_version(spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, v int, x double"), at) == 2
    sinks.append_version(spark.createDataFrame([("a", 2, 5.0)], "k string, v int, x double"), at)
    assert {r.k: r.x for r in sinks.current(spark, at, ["k"], "v").collect()} == {"a": 5, "b": 2}
    sinks.compact(spark, at, str(tmp_path / "c"), ["k"], "v")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    sinks.write_csv(spark.createDataFrame([("t", 2.0, None)], "track string, b double, a double"), str(tmp_path / "csv"))
    assert records.feature_csv(spark, str(tmp_path / "csv"), []).columns == ["track", "a", "b"]
    sinks.write_events(spark.createDataFrame([("t", 2.0), ("t", 1.0)], "track string, t double"), str(tmp_path / "e"), "track")
    assert "".join(p.read_text() for p in (tmp_path / "e" / "track=t").glob("*.txt")) == "1.000000\n2.000000\n"


def test_merge_and_fill(spark):
    old = spark.createDataFrame([("a", {"x": 1, "y": 2}), ("b", {})], "k string, m map<string,int>")
    new = spark.createDataFrame([("a", {"y": 3})], "k string, m map<string,int>")
    assert {r.k: r.m for r in R.merge_records(old, new, "k", "m").collect()} == {"a": {"x": 1, "y": 3}, "b": {}}
    assert {r.k: r.m for r in R.merge_records(old, new, "k", "m", new_wins=False).collect()}["a"] == {"x": 1, "y": 2}
    f = R.keep_first_by_fingerprint(spark.createDataFrame([(1, "p"), (2, "p"), (3, None), (4, None)], "i int, f string"), F.col("f"), ["i"])
    assert sorted(r.i for r in f.collect()) == [1, 3, 4]
    assert R.seeded_sample(spark.range(1000), "id", 400).count() == 400 and R.seeded_sample(spark.range(10), "id", 400).count() == 10


def test_empty_tables(spark):
    e = spark.createDataFrame([], "track long, t double, row long")
    g = E.intervals(e, tie="row")
    assert E.interval_stats(g).count() == E.interval_entropy(g).count() == E.islands(e, 1.0).count() == 0
    assert V.histogram(e, "t").count() == 0 and V.two_sigma(e, "t", "t").count() == 0
    assert P.numeric_profile(P.unpivot(e, ["track"], ["t"]), ["track"]).count() == 0


def test_entropy_of_equal_gaps(spark):
    e = spark.createDataFrame([(1, float(i), i) for i in range(5)], "track long, t double, row long")
    g = E.intervals(e)
    assert E.interval_entropy(g).first().entropy == 0
    s = E.interval_stats(g).first()
    assert (s.cv, s.evenness) == (0, 1)


def test_near_any_and_inside(spark):
    a = spark.createDataFrame([(1, 1.0, 0), (1, 2.0, 1), (2, 1.0, 2)], "track long, t double, row long")
    b = spark.createDataFrame([(1, 1.07)], "track long, t double")
    assert {r.row: r.near for r in E.near_any(a, b, 0.0701).collect()} == {0: True, 1: False, 2: False}


def test_density_counts_empty_windows(spark):
    e = spark.createDataFrame([(1, 0.5), (1, 9.0)], "track long, t double")
    r = E.window_density(e, spark.createDataFrame([(1, 10.0)], "track long, duration double"), 4.0, 2.0).first()
    rates = [1 / 4, 0, 0, 1 / 4, 1 / 2]
    assert r.n_windows == 5 and r.mean_rate == pytest.approx(np.mean(rates)) and r.var_rate == pytest.approx(np.var(rates))


def test_crops(spark):
    assert bar_crops([0.5 * i for i in range(41)], 20.0, 5.2)[0] == (0, 3.5)
    assert bar_crops([], 10.0, 4.0) == [(0, 4), (4, 8), (8, 10)]
    t = spark.createDataFrame([("a", 10.0, 1.0)], "track string, duration double, start double")
    assert [(r.start, r.end) for r in tiles(t, 4.0).orderBy("i").collect()] == [(1, 5), (5, 9)]
    assert crop_tracks(t, spark.createDataFrame([], "track string, t double"), 4.0).count() == 3


def test_models_against_numpy(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 0.1 * r.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, c double, y double")
    comp, share, _ = T.principal_components(df, ["a", "b", "c"], 2)
    u = np.linalg.svd(x - x.mean(0))[2]
    assert np.allclose(np.abs(comp), np.abs(u[:2])) and share[0] >= share[1]
    coef = [q.coefficient for q in T.ridge(df, ["a", "b", "c"], "y", 1e-6).collect()]
    assert coef == pytest.approx(list(np.array([1, -2, 0.5]) * x.std(0)), abs=0.05)
    vif = {q.feature: q.vif for q in T.variance_inflation(df, ["a", "b", "c"]).collect()}
    assert vif["a"] == pytest.approx(np.linalg.inv(np.corrcoef(x.T))[0, 0])
    assert T.ward_clusters(np.array([[0, 0.1, 1], [0.1, 0, 1], [1, 1, 0]])).tolist() == [0, 0, 1]
    flat = df.withColumn("k", F.lit(1.0))
    m = {(q.x, q.y): q.r for q in T.correlation_matrix(flat, ["a", "k"]).collect()}
    assert m["a", "k"] == 0 and m["k", "k"] == 0 and m["a", "a"] == pytest.approx(1)


def test_cosine_neighbours_over_blocks(spark):
    v = np.random.default_rng(1).normal(size=(50, 4))
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(v)], "id long, v array<double>")
    got = {(r.id, r.rank): (r.other, r.score) for r in N.nearest_by_cosine(df, "id", "v", 3, block=16).collect()}
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(n @ n.T, 4)
    for i in range(50):
        want = sorted((-s[i, j], j) for j in range(50) if j != i)[:3]
        assert [got[i, k + 1][0] for k in range(3)] == [j for _, j in want]


def test_classes_fold(spark):
    df = spark.createDataFrame([(c, 1.0, 1.0) for c in ["a", "a", "b", "c", "", None]], "c string, x double, y double")
    assert {r.label: r.n for r in V.classes(df, F.col("c"), "x", "y", 2).collect()} == {"(unknown)": 2, "a": 2, "(other)": 2}


def test_cosine_neighbours_of_many_blocks_with_ties(spark):
    r = np.random.default_rng(2)
    v = np.r_[r.normal(size=(300, 3)), np.ones((40, 3))].astype(np.float32)
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(v)], "id long, v array<float>")
    found = N.nearest_by_cosine(df, "id", "v", 5, block=8)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()  # candidates of a pair of blocks aren't shuffled
    got = {(x.id, x["rank"]): (x.other, x.score) for x in found.collect()}
    v = v.astype(float)
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(n @ n.T, 4)
    want = {(i, k + 1): (j, -x + 0.0) for i in range(len(v)) for k, (x, j) in enumerate(sorted((-s[i, j], j) for j in range(len(v)) if j != i)[:5])}
    assert got == want
    few = N.nearest_by_cosine(df, "id", "v", 5, block=8, groups=4)
    assert few.rdd.getNumPartitions() == 4  # copies of a row are bounded
    assert {(x.id, x["rank"]): (x.other, x.score) for x in few.collect()} == want
