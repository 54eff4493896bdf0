"""Feature store, commit log, as-of scan, tick-grain recurrences, correlations,
fitted normalisation and models, against plain Python."""

import bisect
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions.recurrence import EMA_COLS, ema_frame
from tickloom.functions.scan import tick_indicators
from tickloom.operators import clean as C
from tickloom.operators import correlation as CORR
from tickloom.operators import joins as D
from tickloom.operators import performance as PERF
from tickloom.operators import scoring as I
from tickloom.operators import store as H
from tickloom.operators.feature_store import FeatureStore, object_id
from tickloom.sources.commits import CommitLog

KV = "k string, d int, x double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---------------------------------------------------------------- commit log
def test_commits_are_whole_and_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.numbers() == [] and log.latest() is None
    assert log.publish(1, {"a": "é"}) and not log.publish(1, {"a": "other"})
    assert log.publish(2, {"b": [1, 2]})
    assert log.numbers() == [1, 2] and log.read(1) == {"a": "é"} and log.latest() == (2, {"b": [1, 2]})


# ---------------------------------------------------------------- feature store
def test_upsert_rewrites_only_what_changes(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=4)
    data = spark.createDataFrame([(f"k{i}", 0, float(i)) for i in range(40)], KV)
    ident, first = store.upsert(data, "f", ["k", "d"], "stock", parameters={"w": 1})
    assert (ident, first) == (object_id("f", "latest", {"w": 1}), 1)
    before = store.metadata(feature_id=ident)["buckets"]
    assert store.upsert(data, "f", ["k", "d"], "stock", parameters={"w": 1}) == (ident, 1)  # again: nothing written
    change = spark.createDataFrame([("k3", 0, -1.0), ("k3", 0, -2.0), ("new", 1, None)], KV)
    assert store.upsert(change, "f", ["k", "d"], "stock", parameters={"w": 1}) == (ident, 2)
    body = store.metadata(feature_id=ident)
    kept = [b for b in before if before[b]["folder"] == body["buckets"][b]["folder"]]
    assert 2 <= len(kept) < 4  # at most two buckets are new
    want = sorted([(f"k{i}", 0, -1.0 if i == 3 else float(i)) for i in range(40)] + [("new", 1, None)], key=str)
    assert sorted((tuple(r) for r in store.load(feature_id=ident).collect()), key=str) == want
    import json
    stats = json.loads(body["stats"])
    x = [v for _, _, v in want if v is not None]
    assert stats["shape"] == [41, 3] and stats["description"]["x"]["count"] == 40
    assert math.isclose(stats["description"]["x"]["mean"], np.mean(x))
    assert math.isclose(stats["description"]["x"]["std"], np.std(x, ddof=1))
    assert store.load("f", entity_type="stock").count() == 41
    with pytest.raises(ValueError):
        store.upsert(data.withColumn("y", F.lit(1)), "f", ["k", "d"], "stock", parameters={"w": 1})


def test_a_second_writer_starts_over(spark, tmp_path, monkeypatch):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=2)
    ident = store.save(spark.createDataFrame([("a", 0, 1.0)], KV), "f", ["k", "d"], "stock")
    other = FeatureStore(spark, store.root, buckets=2)
    publish, met = CommitLog.publish, []

    def late(log, number, body):
        if not met:  # while this writer works, another commits
            met.append(number)
            other.upsert(spark.createDataFrame([("b", 0, 2.0)], KV), "f", ["k", "d"], "stock")
        return publish(log, number, body)

    monkeypatch.setattr(CommitLog, "publish", late)
    store.upsert(spark.createDataFrame([("c", 0, 3.0)], KV), "f", ["k", "d"], "stock")
    assert [r[0] for r in rows(store.load(feature_id=ident))] == ["a", "b", "c"]
    assert store.metadata(feature_id=ident)["commit"] == 3


def test_only_missing_keys_are_computed(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"))
    asked = []

    def compute(missing):
        asked.append(sorted(r.k for r in missing.collect()))
        return missing.select("k", F.lit(1).alias("d"), F.length("k").cast("double").alias("x"))

    want = spark.createDataFrame([("a",), ("bb",), ("bb",), (None,)], "k string")
    assert rows(store.get_or_compute(want, compute, "f", ["k", "d"], "t")) == [("a", 1, 1.0), ("bb", 1, 2.0)]
    more = spark.createDataFrame([("bb",), ("ccc",)], "k string")
    assert rows(store.get_or_compute(more, compute, "f", ["k", "d"], "t")) == [("bb", 1, 2.0), ("ccc", 1, 3.0)]
    store.get_or_compute(more, compute, "f", ["k", "d"], "t")
    assert asked == [["a", "bb"], ["ccc"]]
    assert store.metadata("f")["commit"] == 2


def test_versions_sets_and_listings(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"))
    assert store.list_features().count() == 0 and store.metadata("none") is None
    with pytest.raises(KeyError):
        store.load("none")
    one = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0)], KV)
    two = spark.createDataFrame([("b", 0, 5.0), ("c", 0, 6.0)], KV)
    i1 = store.save(one, "f", ["k", "d"], "stock", version="v1", parameters={"w": 5, "who": "x"})
    i2 = store.save(two, "f", ["k", "d"], "stock", version="v2")
    g = store.save(two.withColumnRenamed("x", "y"), "g", ["k", "d"], "fund")
    assert rows(store.load("f")) == rows(two) and rows(store.load("f", version="v1")) == rows(one)
    listed = store.list_features(entity_type="stock").collect()
    assert [r.id for r in listed] == [i2, i1] and listed[1].parameters == {"w": "5", "who": "x"}
    assert listed[0].stats.shape == [2, 3] and store.list_features(name="g").first().id == g
    s = store.save_set("all", [i1, g])
    assert sorted((tuple(r) for r in store.load_set("all").collect()), key=str) == sorted(
        [("a", 0, 1.0, None), ("b", 0, 2.0, 5.0), ("c", 0, None, 6.0)], key=str)
    assert [m.id for m in store.list_sets().first().features] == [i1, g] and store.load_set(set_id=s).count() == 3
    assert store.load_set(set_id=store.save_set("two", [i1, i2])).columns == ["k", "d", "f_v1_x", "f_v2_x"]
    with pytest.raises(KeyError):
        store.save_set("bad", ["nothing"])


def test_weights_upsert_is_idempotent(spark):
    schema = "portfolio_id string, ticker string, weight double, updated_at int"
    stored = spark.createDataFrame([("p", "A", 0.4, 1), ("p", "B", 0.6, 1), ("q", "A", 1.0, 5)], schema)
    updates = spark.createDataFrame([("p", "A", 1.0, 1), ("q", "A", 0.5, 7), ("r", "B", 1.0, 2)], schema)
    once = H.upsert_portfolio_weights(stored, updates)
    assert rows(once) == [("p", "A", 1.0, 1), ("q", "A", 1.0, 5), ("r", "B", 1.0, 2)]
    assert rows(H.upsert_portfolio_weights(once, updates)) == rows(once)


# ---------------------------------------------------------------- as-of scan
@pytest.mark.parametrize("by", [None, "key"])
def test_asof_equals_search(spark, by):
    rng = np.random.default_rng(1)
    t0 = dt.datetime(2024, 1, 1)

    def table(n, name):
        out = []
        for i in range(n):
            key = "hot" if rng.random() < 0.4 else f"k{rng.integers(0, 5)}"
            when = None if rng.random() < 0.02 else t0 + dt.timedelta(seconds=int(rng.integers(0, 40) ** 3))
            out.append((None if rng.random() < 0.02 else key, when, i))
        return out, spark.createDataFrame(out, f"key string, ts timestamp_ntz, {name} int")

    left_rows, left = table(300, "l")
    right_rows, right = table(120, "r")
    if by is None:
        right = right.drop("key")
    want = []
    for key, when, i in left_rows:
        fits = [(t, r) for k, t, r in right_rows if t is not None and when is not None and t <= when
                and (by is None or (k is not None and k == key))]
        want.append((i, max(fits)[1] if fits else None))
    for width, group in ((3600, 1024), (60, 2), (7, 3)):
        got = D.asof_join(left, right, on="ts", by=by, tiebreak=["r"], width_seconds=width, group=group)
        assert sorted((r.l, r.r) for r in got.collect()) == sorted(want, key=lambda x: x[0])
    plan = D.asof_join(left, right, on="ts", by=by, tiebreak=["r"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and not [x for x in plan.splitlines() if "Window [" in x and x.rstrip().endswith("[ts ASC NULLS FIRST]")
                                       and "[_b" not in x and "_b#" not in x]


# ---------------------------------------------------------------- recurrences
@pytest.mark.parametrize("blocks", [1, 7, 40])
def test_tick_indicators_equal_the_sequential_definition(spark, blocks):
    rng = np.random.default_rng(3)
    data = []
    for i in range(700):
        key = "hot" if i % 3 else f"k{i % 4}"
        data.append((key, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(rng.integers(0, 500))), i,
                     None if i % 50 == 7 else float(rng.normal(100, 5)) if key != "k0" else 7.0))
    data += [(None, dt.datetime(2024, 1, 1), 900, 1.0), ("one", dt.datetime(2024, 1, 1), 901, 2.0)]
    ticks = spark.createDataFrame(data, "ticker string, ts timestamp_ntz, id int, price double")
    got = {r.id: r for r in tick_indicators(ticks, order=("ts", "id"), blocks=blocks).collect()}
    assert len(got) == len(data)
    pdf = pd.DataFrame(data, columns=["ticker", "ts", "id", "price"]).dropna().sort_values(["ticker", "ts", "id"])
    for _, g in pdf.groupby("ticker"):
        want = ema_frame(g["price"].reset_index(drop=True))
        for i, r in zip(g["id"], want.to_dict("records")):
            for c in EMA_COLS:
                a, b = got[i][c], r[c]
                assert (a is None) == math.isnan(b) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), (i, c)
    assert all(got[i][c] is None for i in (7, 57, 900) for c in EMA_COLS)


# ---------------------------------------------------------------- correlations
def test_correlations_of_chosen_pairs(spark):
    rng = np.random.default_rng(4)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(50)]
    data = [(t, d, None if rng.random() < 0.05 else float(rng.normal(50, 9))) for t in "ABCDE" for d in days if rng.random() < 0.9]
    data += [("F", d, 3.0) for d in days]
    panel = spark.createDataFrame(data, "ticker string, date date, close double")
    partners = [("A", "B"), ("B", "A"), ("C", "A"), ("A", "F"), ("D", "D"), ("E", "none")]
    table = spark.createDataFrame(partners, "ticker string, other string")
    for block in (1, 32):
        got = CORR.pair_correlations(panel, table, windows=(5, 8), backfill=False, block=block).collect()
        assert {(r.ticker, r.other) for r in got} == {("A", "B"), ("B", "A"), ("C", "A"), ("A", "F")}
        frame = pd.DataFrame(data, columns=["ticker", "date", "close"])
        for a, b in {(r.ticker, r.other) for r in got}:
            x = frame[frame.ticker == a].set_index("date").close
            y = frame[frame.ticker == b].set_index("date").close
            both = pd.concat([x, y], axis=1, join="inner", keys=["x", "y"]).sort_index().astype(float)
            mine = {r.date: r for r in got if (r.ticker, r.other) == (a, b)}
            assert sorted(mine) == list(both.index)
            for n in (5, 8):
                want = both["x"].where(both["y"].notna()).rolling(n).corr(both["y"].where(both["x"].notna()))
                for d, w in want.items():
                    g = mine[d][f"Corr_{n}d"]
                    if "F" in (a, b) or math.isnan(w) or math.isinf(w):
                        assert g is None
                    else:
                        assert math.isclose(g, w, abs_tol=1e-9)
    assert CORR.pair_correlations(panel.limit(0), table).count() == 0
    assert D.pair_align(panel, table).filter("ticker = 'D' OR other = 'D'").count() == 0
    assert D.all_pairs(panel).count() == 30


def test_next_valid_and_trailing_moments():
    nan = math.nan
    assert np.array_equal(CORR.next_valid(np.array([nan, 1, nan, 2, nan])), [1, 1, 2, 2, nan], equal_nan=True)
    mean, std = PERF.trailing_moments(np.array([0.1] * 6 + [0.4]), 3)
    assert np.isnan(std[:2]).all() and (std[2:6] == 0).all() and math.isclose(std[6], pd.Series([.1, .1, .4]).std())


# ---------------------------------------------------------------- normalisation, models
def test_normalizer_learns_from_training_rows_only(spark):
    schema = "ticker string, date date, open double, high double, low double, close double, volume double, split string"
    day = dt.date(2024, 1, 1)
    data = [("A", day, 0.0, 2.0, 2.0, 4.0, 10.0, "train"), ("A", day + dt.timedelta(1), 5.0, 4.0, 2.0, 8.0, 20.0, "train"),
            ("A", day + dt.timedelta(2), 10.0, 8.0, 1.0, 2.0, 80.0, "test"), ("B", day, 3.0, 3.0, 3.0, 3.0, 3.0, "test")]
    bars = spark.createDataFrame(data, schema)
    fitted = C.fit_normalizer(bars.filter("split = 'train'"))
    got = {(r.ticker, r.date.day): tuple(r)[2:7] for r in C.apply_normalizer(bars, fitted).collect()}
    assert got[("A", 3)] == (2.0, 4.0, 0.5, 0.5, 4.0) and got[("A", 1)] == (0.0, 1.0, 1.0, 1.0, 0.5)
    assert got[("B", 1)] == (1.0, 1.0, 1.0, 1.0, 0.1)


def test_a_model_loads_once_per_worker(spark, tmp_path):
    seen = str(tmp_path)

    def load():
        import os
        import tempfile

        class Sum:
            def predict(self, x):
                return x.sum(1)
        open(os.path.join(seen, f"{os.getpid()}_{next(tempfile._get_candidate_names())}"), "w").close()
        return Sum()

    panel = spark.range(200).select((F.col("id") % 5).cast("string").alias("ticker"), F.col("id").cast("int").alias("step"),
                                    F.lit(1.0).alias("close"), F.col("id").cast("double").alias("volume"))
    tensors = C.observation_tensors(panel.repartition(20), n=4, features=("close", "volume"))
    got = I.score_windows(tensors, load).collect()
    assert len(got) == 200
    import os
    pids = [f.split("_")[0] for f in os.listdir(seen)]
    assert len(pids) == len(set(pids))
    long = C.observation_windows(panel, n=4, features=("close", "volume")).groupBy("ticker", "step").agg(F.sum("value").alias("v"))
    want = {(r.ticker, r.step): r.v for r in long.collect()}
    assert all(math.isclose(r.score, want[(r.ticker, r.step)], abs_tol=1e-9) for r in got)
