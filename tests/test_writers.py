"""Writers and small joins: snapshots, per-batch sink, feature save/load,
set operations and report rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.plans.catalog import daily_bars

SF = "/root/testdata/sf0.001"


def test_snapshots_latest_and_inventory(spark, tmp_path):
    from tickloom.sources import files as A
    bars = daily_bars(spark, SF)
    path, cat = str(tmp_path / "snap"), str(tmp_path / "cat")
    A.write_snapshot(bars.filter(F.col("date") < "1998-01-01"), path, "2024-01-01", {"split": "old"}, cat)
    A.write_snapshot(bars, path, "2024-02-01", {"split": "all"}, cat)
    snaps = spark.read.parquet(path)
    latest = A.latest_snapshot(snaps)
    assert latest.count() == bars.count()
    assert spark.read.parquet(cat).count() == 2
    newest = A.read_latest_snapshot(spark, path)
    assert newest.count() == bars.count() and len(newest.inputFiles()) < len(snaps.inputFiles())
    with pytest.raises(FileNotFoundError):
        A.read_latest_snapshot(spark, str(tmp_path))
    merged = A.merge_snapshots(snaps.drop("n_ticks"))
    assert merged.count() == bars.count()
    assert A.date_range(bars, "1996-01-01", "1996-12-31").filter(F.year("date") != 1996).count() == 0


def test_foreach_batch_sink(spark, tmp_path):
    """A per-batch callback writes each non-empty micro-batch."""
    from tickloom.streaming import ticks as K
    src = tmp_path / "in"
    sch = "ticker string, ts timestamp, price double"
    for i in range(2):
        spark.createDataFrame([("T", dt.datetime(2024, 1, 1, i), float(i))], sch) \
            .coalesce(1).write.parquet(str(src / f"b{i}"))
    stream = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(str(src))
    out = str(tmp_path / "out")
    K.drain(stream, out, str(tmp_path / "ck"), foreach_batch=lambda b, e: K.write_batch(b, e, out))
    assert spark.read.parquet(out).count() == 2


def test_save_and_load_feature(spark, tmp_path):
    from tickloom.operators import store as H
    bars = daily_bars(spark, SF).select("ticker", "date", "close")
    cat = str(tmp_path / "catalog")
    i1 = H.save_feature(bars.limit(10), str(tmp_path / "f1"), cat, "close", "v1", "stock", {"window": 14})
    i2 = H.save_feature(bars, str(tmp_path / "f2"), cat, "close", "v2", "stock", {"window": 14})
    assert i1 != i2
    assert H.load_feature(spark, cat, "close").count() == bars.count()          # latest
    assert H.load_feature(spark, cat, "close", "v1").count() == 10
    row = spark.read.parquet(cat).filter(F.col("version") == "v2").first()
    assert '"n_cols":1' in row.stats and row.parameters == '{"window": 14}'


def test_set_operations_and_report(spark):
    from tickloom.operators import joins as D
    from tickloom.operators import store as H
    bars = daily_bars(spark, SF)
    cd = D.common_dates(bars.filter(F.col("ticker").isin("1", "2")))
    both = bars.filter(F.col("ticker") == "1").select("date").intersect(
        bars.filter(F.col("ticker") == "2").select("date"))
    assert sorted(r[0] for r in cd.collect()) == sorted(r[0] for r in both.collect())
    exp = spark.createDataFrame([("open",), ("close",), ("vwap",)], "feature string")
    have = spark.createDataFrame([("open",), ("close",)], "feature string")
    assert [r[0] for r in D.missing_features(exp, have).collect()] == ["vwap"]
    tr = spark.createDataFrame([("p", 1.0)], "portfolio_id string, mean_reward double")
    ev = spark.createDataFrame([("p", 7.0)], "portfolio_id string, total_return double")
    gt = spark.createDataFrame([("p", "deploy")], "portfolio_id string, decision string")
    rep = H.run_report(tr, ev, gt).first()
    assert rep.decision == "deploy" and '"total_return":7.0' in rep.report
    runs = spark.createDataFrame([("r1", 0.5)], "run_id string, sharpe double")
    vers = spark.createDataFrame([("r1", "3")], "run_id string, version string")
    assert H.runs_with_versions(runs, vers).first().version == "3"


def test_stage_registry(spark):
    from tickloom.operators import indicators as IND
    bars = daily_bars(spark, SF)
    IND.register_stage("vwap_gap", lambda df: df.withColumn("gap", F.col("close") - F.col("open")))
    out = IND.apply_stages(bars, ["price", "vwap_gap"])
    assert {"MA_20d", "gap"} <= set(out.columns)
