from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomvec.operators import request_log

START = dt.datetime(2024, 1, 1)


def log(spark, n=3000, runs=("hot", "small", "tiny")):
    """One run has most of the requests; many end in the same second or microsecond."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        run = runs[0] if i % 10 else runs[1]
        if i < 4:
            run = runs[2]
        done = START + dt.timedelta(milliseconds=int(i * 5 // 7 * 7))
        rows.append((i, run, done, float(rng.lognormal(3)), 8, 8 * int(rng.integers(10, 50)), int(i % 97 == 0)))
    frame = pd.DataFrame(rows, columns=["request_id", "run", "done_at", "latency_ms", "docs", "tokens", "error"])
    return frame, spark.createDataFrame(frame).repartition(5)


KEYS = ["run"]


# Requests each run of 2,697, 299 and 4 loses, worked out by hand for (warm-up, trial) seconds.
DROPPED = {
    (3.0, 20.0): {"hot": 404, "small": 44, "tiny": 0},  # 15 %: 404.55 and 44.85; runs of up to 5 keep all
    (0.0, 20.0): {"hot": 0, "small": 0, "tiny": 0},
    (15.0, 20.0): {"hot": 674, "small": 74, "tiny": 0},  # 75 %, but never more than a quarter
    (0.001, 20.0): {"hot": 0, "small": 0, "tiny": 0},
}


def trimmed(frame, warmup, trial):
    ordered = frame.sort_values(["done_at", "request_id"]).groupby("run")
    return pd.concat([part.iloc[DROPPED[warmup, trial][run] :] for run, part in ordered])


@pytest.mark.parametrize(("warmup", "trial"), [(3.0, 20.0), (0.0, 20.0), (15.0, 20.0), (0.001, 20.0)])
@pytest.mark.parametrize("rows_in_a_task", [0, 1_000_000])
def test_warmup_trim(spark, monkeypatch, warmup, trial, rows_in_a_task):
    monkeypatch.setattr(request_log, "ROWS_IN_A_TASK", rows_in_a_task)
    frame, rows = log(spark)
    kept = request_log.warmup_trim(rows, warmup, trial, KEYS)
    assert sorted(kept.columns) == sorted(rows.columns)
    assert sorted(r.request_id for r in kept.collect()) == sorted(trimmed(frame, warmup, trial)["request_id"])


def test_trial_metrics(spark):
    frame, rows = log(spark)
    found = {r.run: r for r in request_log.trial_metrics(rows, keys=KEYS).collect()}
    kept = trimmed(frame, 3.0, 20.0)
    for run, part in frame.groupby("run"):
        ends = part["done_at"].astype("int64") / {"ns": 1e9, "us": 1e6}[part["done_at"].dt.unit]
        dur = ends.max() - (ends - part["latency_ms"] / 1000).min()
        row = found[run]
        assert (row.docs, row.tokens, row.errors) == tuple(part[["docs", "tokens", "error"]].sum())
        assert row.dur == pytest.approx(dur, abs=1e-5)
        assert row.docs_s == pytest.approx(part["docs"].sum() / dur, rel=1e-5)
        latency = kept[kept["run"] == run]["latency_ms"]
        assert row.p50_s == pytest.approx(np.median(latency) / 1000)
        assert row.p95_s == pytest.approx(np.percentile(latency, 95) / 1000)


@pytest.mark.parametrize("rows_in_window", [1, 7, 200])
def test_rolling_latency_over_segments(spark, rows_in_window):
    frame, rows = log(spark, 1500)
    rolled = request_log.rolling_latency(rows, KEYS, rows_in_window, segment_rows=250).toPandas()
    assert len(rolled) == len(frame)
    rolled = rolled.set_index("request_id")
    for _, part in frame.sort_values(["done_at", "request_id"]).groupby("run"):
        values = part["latency_ms"].to_numpy()
        for at in range(0, len(values), 37):
            seen = values[max(0, at - rows_in_window + 1) : at + 1]
            row = rolled.loc[part["request_id"].iloc[at]]
            assert row["at"] == at + 1
            assert row["p50_ms"] == pytest.approx(np.percentile(seen, 50))
            assert row["p95_ms"] == pytest.approx(np.percentile(seen, 95))


@pytest.mark.parametrize("rows_in_window", [10, 200, 5000])
def test_rolling_latency_at_ticks(spark, rows_in_window):
    frame, rows = log(spark, 1500)
    found = request_log.rolling_latency_at_ticks(rows, 1, KEYS, rows_in_window, segment_rows=250).toPandas()
    expected = 0
    for run, part in frame.sort_values(["done_at", "request_id"]).groupby("run"):
        for tick in part["done_at"].dt.floor("s").unique():
            seen = part[part["done_at"] < tick + pd.Timedelta(seconds=1)]["latency_ms"].tail(rows_in_window)
            row = found[(found["run"] == run) & (found["tick_start"] == tick)].iloc[0]
            assert row["samples"] == len(seen)
            assert row["p95_ms"] == pytest.approx(np.percentile(seen, 95))
            expected += 1
    assert len(found) == expected


def test_interval_rates_fill_idle_ticks(spark):
    frame, rows = log(spark, 200)
    late = spark.createDataFrame(
        [(10_000, "hot", START + dt.timedelta(seconds=31), 1.0, 8, 80, 0)], rows.schema
    )
    ticks = request_log.interval_rate(rows.unionByName(late), 5, KEYS).where("run = 'hot'").orderBy("tick_start")
    found = ticks.collect()
    assert len(found) == 7
    assert [row.docs for row in found[1:6]] == [0] * 5
    hot = int((frame["run"] == "hot").sum())
    runs = frame[frame["run"] == "hot"]
    start = ((runs["done_at"] - START).dt.total_seconds() - runs["latency_ms"] / 1000).min()
    assert found[0].docs_s == pytest.approx(hot * 8 / (5 - start), rel=1e-6)
    assert found[-1].total_docs == (hot + 1) * 8
    assert found[-1].avg_docs_s == pytest.approx((hot + 1) * 8 / (31 - start), rel=1e-6)
    assert request_log.interval_rate(rows.unionByName(late), 5, KEYS, fill=False).where("run = 'hot'").count() == 2


def requests(spark, *seconds):
    rows = [(i, "r", START + dt.timedelta(seconds=s), 0.0, 8, 80, 0) for i, s in enumerate(seconds)]
    return spark.createDataFrame(
        rows, "request_id bigint, run string, done_at timestamp, latency_ms double, docs int, tokens bigint, error int"
    )


def test_rates_use_real_time_around_a_tick(spark):
    ticks = request_log.interval_rate(requests(spark, 4.8, 5.2), 5, KEYS).orderBy("tick_start").collect()
    assert ticks[1].avg_docs_s == pytest.approx(16 / 0.4)
    assert ticks[1].docs_s == pytest.approx(8 / 0.2)


@pytest.mark.parametrize("at_once", [7, 10_000])
def test_long_idle_times_are_filled_without_gaps(spark, monkeypatch, at_once):
    monkeypatch.setattr(request_log, "TICKS_AT_ONCE", at_once)
    ticks = request_log.interval_rate(requests(spark, -250_000, 0, 12), 5, KEYS)
    facts = ticks.agg(F.count("*"), F.min("tick_start"), F.max("tick_start"), F.sum("docs"), F.count_if(F.col("docs") > 0), F.count_distinct("tick_start")).first()
    assert tuple(facts) == (50_003, START - dt.timedelta(seconds=250_000), START + dt.timedelta(seconds=10), 24, 3, 50_003)
    assert ticks.where("docs = 0 AND tick_start < timestamp '2024-01-01'").agg(F.max("total_docs")).first()[0] == 8
    # A stray time stamp years away costs no memory: rows are made as they are read.
    assert request_log.interval_rate(requests(spark, -1e9, 0), 5, KEYS).limit(20_000).count() == 20_000


def test_totals_and_summary(spark):
    frame, rows = log(spark)
    totals = request_log.run_totals(rows).first()
    assert totals.requests == len(frame)
    assert totals.docs_ok == frame[frame["error"] == 0]["docs"].sum()
    summary = request_log.latency_summary(rows).first()
    assert summary.p99_ms == pytest.approx(np.percentile(frame["latency_ms"], 99))
    empty = request_log.latency_summary(rows.where(F.lit(False))).first()
    assert (empty.p50_ms, empty.p95_ms, empty.p99_ms) == (0.0, 0.0, 0.0)


def test_instant_run_does_not_divide_by_zero(spark):
    rows = spark.createDataFrame(
        [(1, "r", START, 0.0, 8, 80, 0)],
        "request_id bigint, run string, done_at timestamp, latency_ms double, docs int, tokens bigint, error int",
    )
    row = request_log.trial_metrics(rows, keys=KEYS).first()
    assert row.docs_s == pytest.approx(8e6) and row.p95_s == 0.0
