"""CSV layouts and snapshot metadata."""

import datetime as dt
import json

import pytest

from tickloom.sources import files as A


def _csv(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def _rows(df):
    return sorted((r.ticker, str(r.date), r.open, r.close, r.volume) for r in df.collect())


def test_named_index_row_of_a_two_level_csv(spark, tmp_path):
    p = _csv(tmp_path / "w.csv", "Price,Open,Open,Close,Close\nTicker,AA,BB,AA,BB\nDate,,,,\n"
                                 "2024-01-02,1,2,3,4\n2024-01-03,5,,7,8\n")
    df = A.read_ohlcv(spark, p)
    assert df.columns == ["date", "Open__AA", "Open__BB", "Close__AA", "Close__BB"] and df.count() == 2
    assert _rows(A.to_bars(df)) == [("AA", "2024-01-02", 1.0, 3.0, 1e6), ("AA", "2024-01-03", 5.0, 7.0, 1e6),
                                    ("BB", "2024-01-02", 2.0, 4.0, 1e6), ("BB", "2024-01-03", None, 8.0, 1e6)]


def test_flat_csv(spark, tmp_path):
    p = _csv(tmp_path / "f.csv", ",AA_Open,AA_Close,AA_Volume,B_B_Close\n2024-01-02,1,2,30,4\n2024-01-03,5,6,70,8\n")
    df = A.read_ohlcv(spark, p)
    info = A.detect_layout(df)
    assert info["layout"] == "flat" and info["tickers"] == ["AA", "B_B"]
    bars = A.to_bars(df)
    assert [(t, d, c) for t, d, _, c, _ in _rows(bars)] == [
        ("AA", "2024-01-02", 2.0), ("AA", "2024-01-03", 6.0), ("B_B", "2024-01-02", 4.0), ("B_B", "2024-01-03", 8.0)]


def test_rows_without_a_date_are_kept(spark, tmp_path):
    p = _csv(tmp_path / "s.csv", ",Open,Close\n2024-01-02,1,2\n,3,4\nsoon,5,6\n")
    got = A.to_bars(A.read_ohlcv(spark, p)).collect()
    assert sorted((str(r.date), r.close) for r in got) == [("2024-01-02", 2.0), ("None", 4.0), ("None", 6.0)]


def test_unknown_layout_raises(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0)], "date date, foo double")
    with pytest.raises(ValueError):
        A.to_bars(df)


def test_absent_ticker_without_any_collect(spark):
    df = spark.createDataFrame([("AA", dt.date(2024, 1, 2), 1.0)], "ticker string, date date, Close double")
    out = A.to_bars(df, ["AA", "ZZ"])
    assert _rows(out) == [("AA", "2024-01-02", 1.0, 1.0, 1e6), ("ZZ", "2024-01-02", 100.0, 130.0, 1e6)]


def test_snapshot_metadata(spark, tmp_path):
    df = spark.createDataFrame([("AA", dt.date(2024, 1, 2), 1.0), ("BB", dt.date(2024, 1, 5), 2.0)],
                               "ticker string, date date, close double")
    cat = str(tmp_path / "cat")
    A.write_snapshot(df, str(tmp_path / "data"), "2024-02-01", {"split": "train"}, cat)
    r = spark.read.parquet(cat).first()
    assert (r.n_rows, r.n_cols, r.n_tickers, r.first_date, r.last_date) == (2, 3, 2, "2024-01-02", "2024-01-05")
    assert json.loads(r.dtypes)["close"] == "double" and json.loads(r.metadata) == {"split": "train"}


def test_exact_sums_keep_their_units(spark):
    from tickloom.plans.rounding import round_df
    df = spark.createDataFrame([(123456789012.25, 123456789012.25)], "volume double, value double")
    r = round_df(df, {"volume": 2}).first()
    assert r.volume == 123456789012.25 and r.value == 123456790000.0
