"""Lag over split keys, first rows and their independence of the partitioning."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from boardlens.operators import windows
from boardlens.operators.windows import first_of_newest, first_per_key, row_lag
from boardlens.plans import governance as gov
from boardlens.sources.tables import snapshot

START = dt.date(2020, 1, 1)


def series(spark, sizes: dict, gap=lambda i: i):
    """Rows (k, d, v) with a null value every seventh row."""
    table = [
        (key, START + dt.timedelta(days=gap(i)), i, None if i % 7 == 3 else float(i * i))
        for key, size in sizes.items()
        for i in range(size)
    ]
    return spark.createDataFrame(table, "k string, d date, i int, v double")


@pytest.mark.parametrize("split_rows", [3, 5, 50, 10_000])
@pytest.mark.parametrize("gap", [lambda i: i, lambda i: i // 6, lambda i: (i // 20) * 3])
def test_split_lag_equals_pandas(spark, split_rows, gap):
    df = series(spark, {"hot": 200, "a": 9, "b": 3, "c": 40, None: 5}, gap)
    out = row_lag(df.repartition(7), "k", ["d", "i"], "v", 4, "prev", split_rows)
    got = {(r["k"], r["i"]): r["prev"] for r in out.collect()}
    pdf = df.toPandas().dropna(subset=["k"]).sort_values(["k", "d", "i"])
    pdf["prev"] = pdf.groupby("k")["v"].shift(4)
    want = {
        (k, i): None if pd.isna(p) else p for k, i, p in zip(pdf["k"], pdf["i"], pdf["prev"])
    }
    assert got == want


@pytest.mark.parametrize("order", [["i"], ["i", "d"], ["day", "i"]])
def test_any_order_column_on_both_ways(spark, order):
    """All rows of one day, integer order and null dates split like others."""
    df = series(spark, {"hot": 60, "a": 9}, gap=lambda i: 0).withColumn("day", F.lit(None).cast("date"))
    split = row_lag(df, "k", order, "v", 4, "prev", 5)
    plain = row_lag(df, "k", order, "v", 4, "prev")
    assert split.columns == plain.columns and set(split.collect()) == set(plain.collect())


def test_undated_rows_come_first(spark):
    df = series(spark, {"hot": 60}).withColumn("d", F.when(F.col("i") > 9, F.col("d")))
    split = row_lag(df, "k", ["d", "i"], "v", 4, "prev", 5)
    assert set(split.collect()) == set(row_lag(df, "k", ["d", "i"], "v", 4, "prev").collect())


def test_lag_columns(spark):
    out = row_lag(series(spark, {"a": 6}), "k", ["d"], "v", 1, "before")
    assert out.columns == ["k", "d", "i", "v", "before"]


def quarters(spark, table):
    rows = [(t, dt.date(2020 + q // 4, 3 * (q % 4) + 1, 1), roa) for t, q, roa in table]
    return spark.createDataFrame(rows, "ticker string, qdate date, roa double")


def changes(df):
    out = {}
    for r in gov.roa_change(df).collect():
        change = r["roachange"]
        out[r["ticker"]] = None if change is None else round(change, 9)
    return out


def test_roa_change(spark):
    table = [("four", q, 0.1) for q in range(4)]
    table += [("five", q, 0.1 * q) for q in range(5)]
    table += [("newest null", q, [0.0, 0.1, 0.2, 0.3, 0.5, None][q]) for q in range(6)]
    table += [("gap", q, 0.01 * q) for q in (0, 1, 2, 5, 9)]
    table += [("copies", q, 0.1 * q) for q in range(5)] * 3
    table += [("two a day", 0, 0.2), ("two a day", 0, 0.1)]
    table += [("two a day", q, 0.5) for q in (1, 2, 3)]
    table += [(None, q, 0.1) for q in range(6)]
    assert changes(quarters(spark, table)) == {
        "five": 0.4, "newest null": 0.5, "gap": 0.09, "copies": 0.4, "two a day": 0.4,
    }


def test_roa_classes(spark):
    df = quarters(spark, [("a", q, 0.1 * q) for q in range(5)])
    rows = gov.roa_change_class(gov.roa_change(df)).collect()
    assert [tuple(r) for r in rows] == [("a", "Significant Increase")]


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_first_per_key(spark, partitions):
    df = series(spark, {"a": 30, "b": 20}).repartition(partitions)
    out = first_per_key(df, ["k"], [F.col("d").desc()])
    assert {(r["k"], r["i"]) for r in out.collect()} == {("a", 29), ("b", 19)}


@pytest.mark.parametrize("partitions", [1, 5])
def test_first_of_newest(spark, partitions):
    table = [
        ("two directors", 1, "CEO", 2001), ("two directors", 2, "CEO", 2005),
        ("two titles", 1, "CEO", 2005), ("two titles", 1, "Acting CEO", 2001),
        ("equal years", 2, "CEO", 2005), ("equal years", 1, "CEO", 2005),
        ("undated", 1, "CEO", None), ("undated", 2, "CEO", 1990),
        ("all undated", 2, "CEO", None), ("all undated", 1, "CEO", None),
    ]
    df = spark.createDataFrame(table, "t string, d long, role string, y int")
    df = df.repartition(partitions)
    out = first_of_newest(df, "t", "d", "y", ["d", "role"])
    assert out.columns == ["t", "d", "role", "y"]
    assert {(r["t"], r["d"], r["role"]) for r in out.collect()} == {
        ("two directors", 2, "CEO"), ("two titles", 1, "Acting CEO"), ("equal years", 1, "CEO"),
        ("undated", 2, "CEO"), ("all undated", 1, "CEO"),
    }


def test_runs_do_not_follow_the_rows(spark, monkeypatch):
    """A run costs the driver a sample and a task: 200 rows cut at 3 make no more of them than the session shuffles into."""
    made = []
    monkeypatch.setattr(windows, "snapshot", lambda df: made.append(snapshot(df)) or made[-1])
    df = series(spark, {"hot": 200, "a": 90})
    split = row_lag(df, "k", ["d", "i"], "v", 4, "prev", 3)
    assert 2 <= made[0].select("_run").distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(split.collect()) == set(row_lag(df, "k", ["d", "i"], "v", 4, "prev").collect())
