"""Metrics over a log of embedding requests.

The log has one row per request: ``request_id bigint`` (unique), the key columns of
a run (``trial_no, batch, conc`` by default), ``done_at timestamp``,
``latency_ms double``, ``docs int``, ``tokens bigint`` and ``error int`` (0 or 1).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomvec.operators.joins import join_on
from loomvec.operators.ordering import with_positions, with_running_sum
from loomvec.operators.quantiles import exact_percentiles
from loomvec.session import materialise

RUN = ("trial_no", "batch", "conc")

# The shortest duration a rate is divided by, and the samples of the
# rolling latency window.
MIN_SECONDS = 1e-6
ROLLING_ROWS = 2000

# Idle ticks that are made in one go.
TICKS_AT_ONCE = 10_000

# Requests of one run and second that one task puts in order; more are range-sorted over all partitions.
ROWS_IN_A_TASK = 1_000_000


def seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / 1e6


def per_second(amount: Column, duration: Column) -> Column:
    return amount / F.greatest(duration, F.lit(MIN_SECONDS))


def run_totals(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Docs, tokens and errors; ``docs_ok`` leaves out those of failed requests."""
    return log.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        F.sum("docs").cast("bigint").alias("docs"),
        F.sum("tokens").cast("bigint").alias("tokens"),
        F.sum("error").cast("bigint").alias("errors"),
        F.sum(F.when(F.col("error") == 0, F.col("docs")).otherwise(0)).cast("bigint").alias("docs_ok"),
    )


def latency_summary(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exact p50, p95 and p99 in milliseconds over all requests; 0.0 when there are none."""
    summary = exact_percentiles(log, keys, "latency_ms", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99})
    return summary.fillna(0.0, ["p50_ms", "p95_ms", "p99_ms"]).fillna(0, ["n"])


def per_second_totals(log: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    """One row per run and second of completion: the log reduced in a single pass.

    Its size follows the runs' wall time, not their requests.
    """
    started = seconds(F.col("done_at")) - F.col("latency_ms") / 1000
    return log.groupBy(*keys, F.date_trunc("second", "done_at").alias("second")).agg(
        F.count("*").alias("requests"),
        F.sum("docs").cast("bigint").alias("docs"),
        F.sum("tokens").cast("bigint").alias("tokens"),
        F.sum("error").cast("bigint").alias("errors"),
        F.min(started).alias("first_start"),
        F.max(seconds(F.col("done_at"))).alias("last_end"),
    )


def warmup_cuts(
    totals: DataFrame, warmup_secs: float, trial_secs: float, keys: Sequence[str] = RUN
) -> DataFrame:
    """Per run the second its warm-up ends in, and how many of that second's requests to drop.

    A run of n > 5 requests loses ``min(int(n * warmup / trial), n // 4)``.
    """
    in_run = Window.partitionBy(*keys)
    upto = in_run.orderBy("second").rowsBetween(Window.unboundedPreceding, 0)
    share = warmup_secs / max(trial_secs, 1.0)
    n = F.sum("requests").over(in_run)
    trim = F.when(
        (n > 5) & F.lit(warmup_secs > 0),
        F.least(F.floor(n * F.lit(share)), F.floor(n / 4)),
    ).otherwise(0)
    running = totals.select(
        *keys, "second", "requests", F.sum("requests").over(upto).alias("_upto"), trim.alias("_trim")
    )
    before = F.col("_upto") - F.col("requests")
    cut = running.where((F.col("_upto") > F.col("_trim")) & (before <= F.col("_trim")))
    return cut.select(*keys, F.col("second").alias("_second"), (F.col("_trim") - before).alias("_drop"), F.col("requests").alias("_held"))


def warmup_trim(
    log: DataFrame,
    warmup_secs: float = 3.0,
    trial_secs: float = 20.0,
    keys: Sequence[str] = RUN,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Drop each run's first requests in completion order (see :func:`warmup_cuts`).

    Rows of other seconds than the cut's are kept or dropped by their second alone;
    only the cut second's rows are put in order. ``totals`` may pass on what
    :func:`per_second_totals` gave.
    """
    keys = list(keys)
    counts = per_second_totals(log, keys) if totals is None else totals
    cuts = materialise(warmup_cuts(counts, warmup_secs, trial_secs, keys), "cuts")
    marked = join_on(log, cuts, keys)
    second = F.date_trunc("second", "done_at")
    is_cut = second == F.col("_second")
    whole = marked.where((second > F.col("_second")) | (is_cut & (F.col("_drop") == 0)))
    split, order = marked.where(is_cut & (F.col("_drop") > 0)).drop("_second"), ["done_at", "request_id"]
    if (cuts.agg(F.max("_held")).first()[0] or 0) <= ROWS_IN_A_TASK:
        split = split.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        split = with_positions(split, keys, order, "_at")
    kept = split.where(F.col("_at") > F.col("_drop"))
    return whole.select(*log.columns).unionByName(kept.select(*log.columns))


def trial_metrics(
    log: DataFrame, warmup_secs: float = 3.0, trial_secs: float = 20.0, keys: Sequence[str] = RUN
) -> DataFrame:
    """One row per run: totals, rates over the run's wall time, and trimmed p50/p95.

    The wall time runs from the first request's start to the last one's end. Totals
    and rates count all requests, failed ones too; only latencies are trimmed.
    """
    keys = list(keys)
    by_second = materialise(per_second_totals(log, keys), "seconds")
    totals = by_second.groupBy(*keys).agg(
        F.sum("docs").alias("docs"),
        F.sum("tokens").alias("tokens"),
        F.sum("errors").alias("errors"),
        (F.max("last_end") - F.min("first_start")).alias("dur"),
    )
    samples = log.select(*keys, "request_id", "done_at", "latency_ms")
    # Written once: the percentiles read it twice.
    trimmed = materialise(warmup_trim(samples, warmup_secs, trial_secs, keys, by_second).select(*keys, "latency_ms"), "trimmed")
    latency = exact_percentiles(trimmed, keys, "latency_ms", {"p50": 0.5, "p95": 0.95})
    return join_on(totals, latency, keys, "left").select(
        *keys,
        "docs",
        "tokens",
        per_second(F.col("docs"), F.col("dur")).alias("docs_s"),
        per_second(F.col("tokens"), F.col("dur")).alias("toks_s"),
        F.coalesce(F.col("p50") / 1000, F.lit(0.0)).alias("p50_s"),
        F.coalesce(F.col("p95") / 1000, F.lit(0.0)).alias("p95_s"),
        "errors",
        "dur",
    )


def _rolling(
    log: DataFrame, keys: list[str], rows: int, segment_rows: int, tick_micros: int | None
) -> DataFrame:
    """Rolling p50/p95 per request or, with ``tick_micros``, for a segment's last one per tick.

    A run is cut into segments of ``segment_rows`` consecutive requests; each also
    gets the ``rows - 1`` before it, so segments are computed apart however long
    the run is.
    """
    halo = rows - 1
    size = max(segment_rows, rows)
    placed = with_positions(
        log.select(*keys, "request_id", "done_at", "latency_ms"), keys, ["done_at", "request_id"], "at"
    )
    own = F.floor((F.col("at") - 1) / size)
    last_rows = F.pmod(F.col("at") - 1, F.lit(size)) >= size - halo
    tick = F.floor(F.unix_micros("done_at") / (tick_micros or 1))
    spread = placed.withColumn("tick", tick).withColumn(
        "segment", F.explode(F.when(last_rows, F.array(own, own + 1)).otherwise(F.array(own)))
    )

    def roll(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at", ignore_index=True)
        window = part["latency_ms"].rolling(rows, min_periods=1)
        part["p50_ms"] = window.quantile(0.5)
        part["p95_ms"] = window.quantile(0.95)
        part = part[(part["at"] - 1) // size == part["segment"]]
        return part if tick_micros is None else part[part["tick"] != part["tick"].shift(-1)]

    added = [T.StructField("p50_ms", T.DoubleType()), T.StructField("p95_ms", T.DoubleType())]
    schema = T.StructType([*spread.schema.fields, *added])
    return spread.groupBy(*keys, "segment").applyInPandas(roll, schema).drop("segment")


def rolling_latency(
    log: DataFrame, keys: Sequence[str] = RUN, rows: int = ROLLING_ROWS, segment_rows: int = 100_000
) -> DataFrame:
    """p50/p95 over each request and the ``rows - 1`` completed before it in its run."""
    return _rolling(log, list(keys), rows, segment_rows, None).drop("tick")


def rolling_latency_at_ticks(
    log: DataFrame,
    every_secs: int = 5,
    keys: Sequence[str] = RUN,
    rows: int = ROLLING_ROWS,
    segment_rows: int = 100_000,
) -> DataFrame:
    """At the end of each tick with requests: p50/p95 over the last ``rows`` completed."""
    keys, width = list(keys), every_secs * 1_000_000
    rolled = _rolling(log, keys, rows, segment_rows, width)
    # A tick that spans segments has one row of each; the last request's counts.
    last = F.max_by(F.struct("at", "p50_ms", "p95_ms"), "at").alias("v")
    return rolled.groupBy(*keys, "tick").agg(last).select(
        *keys,
        F.timestamp_micros(F.col("tick") * width).alias("tick_start"),
        F.least("v.at", F.lit(rows)).cast("bigint").alias("samples"),
        "v.p50_ms",
        "v.p95_ms",
    )


def interval_rate(
    log: DataFrame,
    every_secs: int = 5,
    keys: Sequence[str] = RUN,
    fill: bool = True,
) -> DataFrame:
    """Docs and tokens per second for each tick of a run, and the average so far.

    Ticks are ``every_secs`` long and aligned to the clock; rates divide by the part of a tick that lies
    inside the run (from its first request's start to its last one's end), averages by the time since that start.
    ``fill`` gives every tick without requests a row with rate 0, however many follow each other. Requests are summed per tick
    before anything is ordered, so windows run over ticks with requests only; idle ticks are
    made from the tick before them afterwards, a bounded number at a time.
    """
    keys = list(keys)
    width = every_secs * 1_000_000
    micros = F.unix_micros("done_at")
    # Epoch-aligned sums first, in one pass over the log; the run's start is their minimum.
    sums = log.groupBy(*keys, F.floor(micros / width).alias("_slot")).agg(
        F.sum("docs").cast("bigint").alias("docs"),
        F.sum("tokens").cast("bigint").alias("tokens"),
        F.sum("error").cast("bigint").alias("errors"),
        F.min(seconds(F.col("done_at")) - F.col("latency_ms") / 1000).alias("_began"),
        F.max(seconds(F.col("done_at"))).alias("_ended"),
    )
    whole, in_run = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_slot")
    idle = F.coalesce(F.lead("_slot").over(in_run) - F.col("_slot") - 1, F.lit(0))
    ticks = sums.select(
        *keys, "_slot", "docs", "tokens", "errors", F.min("_began").over(whole).alias("_began"),
        F.max("_ended").over(whole).alias("_ended"), F.min("_slot").over(whole).alias("_first"), idle.alias("_idle"),
    )
    ticks = ticks.withColumn("total_docs", F.sum("docs").over(in_run.rowsBetween(Window.unboundedPreceding, 0)))
    if fill:
        ticks = ticks.withColumn("_from", F.explode(F.sequence(F.col("_slot"), F.col("_slot") + F.col("_idle"), F.lit(TICKS_AT_ONCE))))
        last = F.least(F.col("_slot") + F.col("_idle"), F.col("_from") + TICKS_AT_ONCE - 1)
        ticks = ticks.withColumn("_tick", F.explode(F.sequence(F.col("_from"), last)))
        own = F.col("_tick") == F.col("_slot")
        ticks = ticks.select(
            *keys, "_began", "_ended", "_first", "total_docs", F.col("_tick").alias("_slot"),
            *[F.when(own, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("docs", "tokens", "errors")],
        )
    seen_to = F.least((F.col("_slot") + 1) * every_secs, "_ended")
    seen_from = F.when(F.col("_slot") == F.col("_first"), F.col("_began")).otherwise(F.col("_slot") * every_secs)
    return ticks.select(
        *keys,
        F.timestamp_micros(F.col("_slot") * width).alias("tick_start"),
        "docs",
        "tokens",
        "errors",
        per_second(F.col("docs"), seen_to - seen_from).alias("docs_s"),
        per_second(F.col("tokens"), seen_to - seen_from).alias("toks_s"),
        "total_docs",
        per_second(F.col("total_docs"), seen_to - F.col("_began")).alias("avg_docs_s"),
    )


def most_open(requests: DataFrame) -> DataFrame:
    """``(most_open)``: how many requests of a log were open at a time at most.

    A request is open from its start to its end; ends count before starts at the same microsecond. Running sums go over a range
    sort of all starts and ends.
    """
    ended = F.unix_micros("done_at")
    # One microsecond on either side is the clock's rounding.
    started = F.least((ended - F.col("latency_ms") * 1000).cast("bigint") + 2, ended)
    moments = requests.select(F.explode(F.array(
        F.struct(started.alias("at"), F.lit(1).alias("step")), F.struct(ended.alias("at"), F.lit(-1).alias("step"))
    )).alias("m")).select("m.*")
    opened = with_running_sum(moments, [], ["at", "step"], "step", "open")
    return opened.agg(F.coalesce(F.max("open"), F.lit(0)).cast("bigint").alias("most_open"))
