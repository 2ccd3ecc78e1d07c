"""Names, the incremental driver, streams of several micro-batches, and smaller operators against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.functions import arrays as A
from featherline.functions import names as M
from featherline.operators import events as E
from featherline.operators import incremental as I
from featherline.operators import listing as L
from featherline.operators import profile as P
from featherline.operators import series as Z
from featherline.plans import models, surface
from featherline.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_names(spark):
    numbers = {"T_0.flac": 0, "My Song_15.flac": 15, "full_mix.flac": None, "a_b.flac": None, "x_3": 3, ".hid_4": 4, "a.b_2.wav": 2}
    assert {k: one(spark, M.crop_number(F.lit(k))) for k in numbers} == numbers
    sections = {"a_section_3.wav": 3, "a_section_x": None, "a_section_1_section_2.wav": None, "a": None}
    assert {k: one(spark, M.section_number(F.lit(k))) for k in sections} == sections
    assert one(spark, M.sidecar(F.lit("/m/Song/full_mix.flac"), ".INFO")) == "/m/Song/Song.INFO" and one(spark, M.crop_sidecar(F.lit("/m/S/S_0.flac"))) == "/m/S/S_0.INFO"
    assert one(spark, M.is_organized(F.lit("/m/S/full_mix.mp3"))) and not one(spark, M.is_organized(F.lit("/full_mix.mp3"))) and not one(spark, M.is_organized(F.lit("/m/S/mix.mp3")))
    assert one(spark, M.label(F.lit("spectral_x_probability"))) == "spec_x_p" and one(spark, M.label(F.lit("production_reverberation"), M.AXIS)) == "prod_reverb"
    assert one(spark, M.plain_punctuation(F.lit("a‑b—c d’s “q”"))) == "a-b--c d's \"q\"" and one(spark, M.unsafe_characters(F.lit("a—b‘"), "‘")) == ["U+2014"]


def test_sections(spark):
    text = "x <!-- script-01-start -->\nold <!-- script-01-end --> y"
    new = one(spark, M.replace_section(F.lit(text), "01", F.lit("new $1 \\ \n")))
    assert new == "x <!-- script-01-start -->\nnew $1 \\\n<!-- script-01-end --> y"
    assert one(spark, M.replace_section(F.lit(new), "01", F.lit("new $1 \\ \n"))) == new
    with pytest.raises(Exception, match="no section"):
        one(spark, M.replace_section(F.lit("nothing"), "01", F.lit("x")))


def test_incremental_runs_do_nothing_twice(spark):
    keys = spark.createDataFrame([(i,) for i in range(6)], "k int")
    store = spark.createDataFrame([(0, {"a": 1.0, "b": 2.0}), (1, {"a": 1.0}), (9, {"z": 0.0})], "k int, payload map<string,double>")
    asked = []

    def work(ready):
        asked.append(sorted(r.k for r in ready.collect()))
        return ready.select("k", F.when(F.col("k") != 3, F.create_map(F.lit("a"), F.lit(7.0), F.lit("b"), F.col("k").cast("double"))).alias("payload"))

    locked = keys.filter("k = 2")
    out = I.run(keys, store, "k", ["a", "b"], work, locked)
    assert {r.k: (r.payload, r.outcome) for r in out.collect()} == {0: ({"a": 1.0, "b": 2.0}, "complete"), 1: ({"a": 7.0, "b": 1.0}, "done"), 2: (None, "locked"), 3: (None, "failed"), 4: ({"a": 7.0, "b": 4.0}, "done"), 5: ({"a": 7.0, "b": 5.0}, "done"), 9: ({"z": 0.0}, "kept")}
    again = I.run(keys, out.filter("payload is not null").select("k", "payload"), "k", ["a", "b"], work, locked)
    assert asked == [[1, 3, 4, 5], [3]] and again.filter("outcome = 'complete'").count() == 4
    assert I.counts(I.status(keys, store, "k", ["a"], overwrite=True)).first().asDict() == {"total": 6, "ready": 6, "complete": 0, "locked": 0}


def batches(spark, path):
    for i in range(3):
        rows = [(i * 10 + j, f"2024-01-0{i + 1} 0{j}:00:00", j % 2, "e", float(i * 10 + j)) for j in range(5)]
        spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("t")).drop("t").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streams_of_three_batches(spark, tmp_path):
    stream = batches(spark, str(tmp_path))
    got = models._run(spark, ingest.last_values(stream), "update", ("user_id",)).collect()
    assert {(r.user_id, r.n, r.value) for r in got} == {(0, 9, 24.0), (1, 6, 23.0)} and len(got) == 2
    windows = models._run(spark, ingest.window_counts(stream, "1 day", "1 day"), "complete").collect()
    assert sorted(r.n for r in windows) == [5, 5, 5]
    assert sorted(r.n for r in models._run(spark, ingest.sessions(stream, "2 hours"), "complete").collect()) == [2, 2, 2, 3, 3, 3]


def test_nearest_against_numpy(spark):
    r = np.random.default_rng(3)
    left = [(int(k), i, float(t)) for i, (k, t) in enumerate(zip(r.integers(0, 4, 60), r.integers(0, 40, 60) / 2, strict=True))]
    right = [(int(k), float(t)) for k, t in zip(r.integers(0, 3, 40), r.integers(0, 20, 40), strict=True)]
    got = E.nearest(spark.createDataFrame(left, "track int, row int, t double"), spark.createDataFrame(right, "track int, t double")).collect()
    for x in got:
        own = [t for k, t in right if k == x.track]
        assert x.nearest == (min(own, key=lambda t: (abs(t - x.t), t)) if own else None)


def test_tempo_by_stable_segments(spark):
    steady, wild = [0.5] * 20, [0.2, 1.9, 0.4, 1.3, 0.9, 1.7]
    times = {1: np.cumsum([0, *steady]), 2: np.cumsum([0, *(wild * 12)]), 3: np.cumsum([0, *(wild * 2), *steady, *(wild * 2)]), 4: [0.0, 0.5]}
    rows = [(k, float(t)) for k, v in times.items() for t in v]
    got = {r.track: r for r in E.validated_tempo(E.intervals(spark.createDataFrame(rows, "track int, t double"))).collect()}
    assert {k: r.defined for k, r in got.items()} == {1: True, 2: False, 3: True, 4: False} and got[3].stable == pytest.approx(10)


def test_semitones(spark):
    w = [float(i % 5) for i in range(12)]
    n, width = 60, 0.25
    centres = [n * (s + 3) / 12 - 3 * (n // 12) for s in range(12)]
    d = [[min(abs(b - c), n - abs(b - c)) for c in centres] for b in range(n)]
    got = one(spark, A.spread_semitones(F.array(*map(F.lit, w)), n, width))
    assert got == pytest.approx([sum(x * math.exp(-0.5 * (y / (width * n / 12)) ** 2) for x, y in zip(w, row, strict=True)) for row in d])
    folded = one(spark, A.fold_to_semitones(F.array(*map(F.lit, got)), n))
    want = [0.0] * 12
    for b, row in enumerate(d):
        want[int(np.argmin(row))] += got[b]
    assert folded == pytest.approx(want)
    t = one(spark, A.steering_target(F.array(*map(F.lit, w)), F.lit(9), {0: 1.0, 7: 0.5}, n))
    assert t.mid == pytest.approx(got) and t.air == pytest.approx([0.3 * x for x in got]) and int(np.argmax(t.bass)) == 45
    assert set(one(spark, A.steering_target(F.array(*map(F.lit, w)), F.lit(None).cast("int"), {0: 1.0}, n)).bass) == {0.0}


def test_dominant_class(spark):
    rows = [(1, x) for x in (5.0, 5.1, 4.9, 5.0, 5.2, 2.0)] + [(2, 13.0)] * 10 + [(3, 0.5), (3, 1.5), (4, None)]
    assert {r.k: r["class"] for r in Z.dominant_class(spark.createDataFrame(rows, "k int, x double"), "k", "x").collect()} == {1: 5, 2: 1, 3: 0}


def test_quantiles_against_numpy(spark):
    r = np.random.default_rng(5)
    rows = [(None if i % 5 == 0 else f"k{i % 3}", float(x)) for i, x in enumerate(np.round(r.normal(size=700), 1))] + [("one", 3.0), ("same", 2.0), ("same", 2.0), ("none", None)] + [("hot", 1.0)] * 500 + [("hot", float(i)) for i in range(100)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    for ranges in (256, 4):
        got = {x.k: x.q for x in P.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", probs, ranges).collect()}
        assert set(got) == {k for k, v in rows if v is not None}
        for k, q in got.items():
            assert q == pytest.approx(np.quantile([v for x, v in rows if x == k and v is not None], probs).tolist())
    assert P.quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", probs).count() == 0


def test_quantiles_of_large_groups_in_any_order(spark):
    r = np.random.default_rng(6)
    v = r.exponential(50.0, 40000)
    probs = [0.1, 0.5, 0.9]
    df = spark.createDataFrame([("a" if i % 3 else None, float(x)) for i, x in enumerate(v)] + [("few", float(x)) for x in range(7)], "k string, v double").repartition(16)
    q = P.quantiles(df, ["k"], "v", probs, 32, 1000)
    assert "percentile_approx" not in q._jdf.queryExecution().optimizedPlan().toString()  # its cuts differ from one evaluation to the next
    want = {"a": v[np.arange(len(v)) % 3 > 0], None: v[::3], "few": np.arange(7.0)}
    got = {x.k: x.q for x in q.collect()}
    assert set(got) == set(want)
    for k, x in want.items():
        assert got[k] == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12)


def test_outliers_are_not_shuffled_by_group(spark):
    rows = [(i, "ab"[i % 2] if i % 7 else None, float(i % 50)) for i in range(2000)] + [(2000, "a", 500.0), (2001, None, -500.0), (2002, "one", 1.0)]
    df = spark.createDataFrame(rows, "i int, k string, v double")
    found = P.iqr_outliers(df, "v", ["k"], ["i"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [coalesce(k" in plan and "SortMergeJoin" not in plan
    assert sorted(x.i for x in found.collect()) == [2000, 2001]


def test_listings_are_read_once(spark, small):
    names = ["A/full_mix.wav", "A/full_mix.flac", "A/drums.mp3", "A/drums.wav", "B/drums.wav", "A/S_1.wav", "A/S_1.mp3", "A/S_1_bass.ogg", "A/S_1_bass.wav", "A/S_1_kick.wav", "A/S_2_bass.ogg", "B/S_1_bass.wav", "A/S_1_bass.txt", "A/bass.wav"]
    files = spark.createDataFrame([(f"/m/{n}",) for n in names], "path string")
    stems, mixes, crops = L.stem_files(files), L.stem_files(files, full_mix=True), L.crop_stem_files(files)
    a = {("/m/A", "drums", "/m/A/drums.wav"), ("/m/A", "bass", "/m/A/bass.wav")}
    assert {tuple(r) for r in stems.collect()} == a and {tuple(r) for r in mixes.collect()} == a | {("/m/A", "full_mix", "/m/A/full_mix.flac")}
    assert [tuple(r) for r in crops.select("folder", "crop", "stem", "path").collect()] == [("/m/A", "S_1", "bass", "/m/A/S_1_bass.wav")]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(stems).count("LogicalRDD") == plan(crops).count("LogicalRDD") == 1
    for df in (surface.stem_files(spark, small), surface.crop_stem_files(spark, small), surface.midi_files(spark, small)):
        assert [x.strip(" :+-") for x in plan(df).splitlines() if "Join" in x] and all("regexp" not in x and "RLIKE" not in x for x in plan(df).splitlines() if "Join" in x)


def test_numeric_profile_in_one_pass_after_its_quantiles(spark):
    v = [float(i) for i in range(9)] + [100.0]
    p = P.numeric_profile(spark.createDataFrame([("a", x) for x in v] + [("none", None), (None, 2.0)], "k string, value double"), ["k"])
    assert p._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2  # once for the quantiles, once for the profile
    got = {r.k: r for r in p.collect()}
    a = got["a"]
    assert (a["count"], a.median, a.min, a.max, a.q1, a.q3, a.iqr, a.outliers, a.outlier_pct) == (10, 4.5, 0.0, 100.0, 2.25, 6.75, 4.5, 1, 10.0)
    assert a["mean"] == pytest.approx(np.mean(v)) and a["std"] == pytest.approx(np.std(v))
    assert (got["none"]["count"], got["none"].median, got["none"].outliers, got["none"].outlier_pct) == (0, None, 0, None)
    assert (got[None]["count"], got[None].median, got[None].iqr) == (1, 2.0, 0.0)
