"""Bars that cross one exchange in compressed blocks, and the stack on them."""

import datetime as dt
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.functions import packed
from tickloom.operators import bars as B
from tickloom.operators import correlation as CORR
from tickloom.operators import indicators as IND
from tickloom.plans.catalog import QUERIES

TICKS = "ticker string, ts {}, price double, volume double, seq struct<k1: long, k2: int>"


def some_ticks(n=3000, seed=5):
    """A ticker with half of all ticks, missing values in every column, NaN prices,
    equal times and ticks that come twice."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        ticker = "hot" if i % 2 else None if i % 97 == 0 else f"t{rng.integers(0, 40)}"
        when = None if i % 89 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 20)))
        price = None if i % 11 == 0 or ticker == "t3" else float("nan") if i % 13 == 0 else float(rng.integers(1, 500)) / 7
        price = 5.0 if price and (i % 101 == 0 or i % 103 == 0) else price  # these may tie
        out.append((ticker, when, price, None if i % 17 == 0 or ticker == "t4" else float(rng.integers(0, 9)),
                    None if i % 101 == 0 else (None if i % 103 == 0 else i, int(rng.integers(0, 3)))))
    return out + out[:50]


def cells(df):
    def plain(v):
        return "nan" if isinstance(v, float) and np.isnan(v) else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str)


def in_parts(bars, then=lambda table: [table], schema=None):
    return CORR.beside_partners(bars, None, 1, (), then, schema or bars.schema)


@pytest.mark.parametrize("grain,kind", [("day", "timestamp_ntz"), ("week", "timestamp"), ("hour", "timestamp_ntz")])
@pytest.mark.parametrize("gathered", [50, 1 << 18])
def test_open_bars_equal_closed_ones(spark, monkeypatch, grain, kind, gathered):
    monkeypatch.setattr(packed, "PACK_ROWS", gathered)
    monkeypatch.setattr(packed, "PART_ROWS", 300)
    ticks = spark.createDataFrame(some_ticks(), TICKS.format(kind)).repartition(3)
    want = B.ohlcv_bars(ticks, grain)
    got = in_parts(B.ohlcv_bars(ticks, grain, closed=False))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert cells(got) == cells(want)


def test_a_task_sends_two_ticks_of_a_bar_at_most(spark):
    hot = spark.range(40_000).select(F.lit("hot").alias("ticker"), F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("price"),
                                     (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id") % 3)).alias("ts"),
                                     F.lit(2.0).alias("volume")).withColumn("seq", F.struct("k"))
    bars = B.ohlcv_bars(hot.coalesce(2), "day", closed=False)
    keys, n = bars.keys, 0
    for r in packed.pack(bars.rows.withColumn("_part", F.lit(0)), combine=bars.combining()).collect():
        block = pa.decompress(r._block, decompressed_size=r._size, codec="zstd")
        n += pa.ipc.read_record_batch(block, packed.payload(bars.rows, "")).num_rows
    assert keys == ["ticker", "date"] and 6 <= n <= 2 * 2 * 3
    assert [r.n_ticks for r in in_parts(bars).orderBy("date").collect()] == [13334, 13333, 13333]


def test_open_bars_are_of_doubles(spark):
    ticks = spark.createDataFrame([], TICKS.format("timestamp_ntz"))
    with pytest.raises(ValueError):
        B.ohlcv_bars(ticks.withColumn("volume", F.lit(1)), "day", closed=False)
    with pytest.raises(ValueError):
        B.ohlcv_bars(ticks, "month", closed=False)
    assert in_parts(B.ohlcv_bars(ticks, "day", closed=False)).count() == 0


def test_partners_beside_bars_equal_those_by_tiles(spark, monkeypatch):
    rng = np.random.default_rng(6)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    data = [(t, d, None if rng.random() < 0.02 else float(rng.integers(10, 99))) for t in "ABCDEF" for d in days if rng.random() < 0.95]
    data += [("G", d, 3.0) for d in days] + [("A", None, 5.0), (None, days[0], 1.0), (None, None, 2.0)]
    bars = spark.createDataFrame(data, "ticker string, date date, close double").repartition(5)
    pairs = [("A", "B", 1), ("A", "C", 1), ("A", "C", 1), ("B", "A", 1), ("B", "D", 2), ("C", "A", 2), ("D", "D", 1), ("E", "none", 1),
             ("E", None, 2), (None, "A", 1), ("F", "G", 1), ("none", "A", 1), ("F", "A", 3), ("D", "A", None)]
    partners = spark.createDataFrame(pairs, "ticker string, other string, rank int")
    few = partners.filter("rank <= 2").distinct()
    long = CORR.pair_correlations(bars, few, (5, 10), backfill=False).join(few, ["ticker", "other"])
    wide = long.groupBy("ticker", "date").agg(*[F.max(F.when(F.col("rank") == r, F.col(f"Corr_{n}d"))).alias(f"Corr_{r}_{n}d")
                                                for r in (1, 2) for n in (5, 10)])
    want = cells(bars.join(wide, ["ticker", "date"], "left"))
    assert sum(r[3] is not None for r in want) > 60 and sum(r[6] is not None for r in want) > 30
    for few_names in (CORR.FEW, 0):
        monkeypatch.setattr(CORR, "FEW", few_names)
        assert cells(IND.partner_columns(bars, partners, 2, (5, 10))) == want


def tables(spark, at, suppliers=400, days=150):
    n = suppliers * days
    k = F.col("id")
    spark.range(n).select((k * 7919 % n).alias("l_orderkey"), (k % 2003).alias("l_partkey"), (k % suppliers).alias("l_suppkey"),
                          (k % 7).cast("int").alias("l_linenumber"), (k % 50 + 1).cast("double").alias("l_quantity"),
                          (F.xxhash64(k) % 900_000 / 100 + 10_000).alias("l_extendedprice"),
                          (F.lit(dt.datetime(1998, 1, 1)) + F.make_dt_interval(F.floor(k / suppliers).cast("int"))).cast("timestamp_ntz")
                          .alias("l_shipdate")).write.parquet(f"{at}/lineitem.parquet")
    spark.range(suppliers).select(k.alias("s_suppkey"), (k % 5).cast("int").alias("s_nationkey")).write.parquet(f"{at}/supplier.parquet")
    return n


def on_disk(spark):
    """Bytes of shuffle files and of tables written on the way."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = {f for f in manager.getAllFiles().mkString("\n").split("\n") if f.endswith(".data")}
    for top, _, names in os.walk(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")):
        files |= {f"{top}/{x}" for x in names}
    return {f: os.path.getsize(f) for f in files if os.path.exists(f)}


def test_the_stack_puts_its_ticks_on_disk_once(spark, tmp_path):
    n = tables(spark, tmp_path)
    before = on_disk(spark)
    got = QUERIES["feature_stack"](spark, str(tmp_path))
    got.write.parquet(str(tmp_path / "out"))
    after = on_disk(spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() == n
    assert sum(v for f, v in after.items() if f not in before) < 40 * n
