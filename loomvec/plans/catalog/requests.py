"""Request-log metrics, with the events table read as a log of nine runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomvec.functions.text import estimate_tokens
from loomvec.operators import request_log
from loomvec.plans import selection
from loomvec.plans.catalog.registry import estimate_tokens_sql, query, table
from loomvec.session import scratch_path
from loomvec.sources.trials import read_trials, write_trials

P95_TARGET = 0.151


def log(spark, sf_dir):
    """Events as requests: ``ts`` is the completion, ``value`` the latency, runs go by user."""
    run = F.col("user_id") % 9
    batch = F.get(F.array(*map(F.lit, (8, 16, 32))), F.floor(run / 3).cast("int"))
    conc = F.get(F.array(*map(F.lit, (16, 32, 64))), (run % 3).cast("int"))
    failed = (F.col("event_type") == "error") & (run % 3 == 2)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        (run + 1).cast("int").alias("trial_no"),
        batch.alias("batch"),
        conc.alias("conc"),
        F.col("ts").cast("timestamp").alias("done_at"),
        F.col("value").alias("latency_ms"),
        batch.alias("docs"),
        (batch * (20 + F.col("event_id") % 50)).alias("tokens"),
        failed.cast("int").alias("error"),
    )


LOG_SQL = """
    SELECT event_id AS request_id, CAST(user_id % 9 + 1 AS INTEGER) AS trial_no,
           [8, 16, 32][(user_id % 9) // 3 + 1] AS batch, [16, 32, 64][user_id % 3 + 1] AS conc,
           ts AS done_at, value AS latency_ms, [8, 16, 32][(user_id % 9) // 3 + 1] AS docs,
           [8, 16, 32][(user_id % 9) // 3 + 1] * (20 + event_id % 50) AS tokens,
           CASE WHEN event_type = 'error' AND user_id % 3 = 2 THEN 1 ELSE 0 END AS error
    FROM events"""

_TRIMMED_SQL = f"""
    SELECT * EXCLUDE (pos, n) FROM (
      SELECT *, row_number() OVER (PARTITION BY trial_no ORDER BY done_at, request_id) AS pos,
             count(*) OVER (PARTITION BY trial_no) AS n FROM ({LOG_SQL}))
    WHERE pos > CASE WHEN n > 5 THEN least(floor(n * CAST(0.15 AS DOUBLE)), n // 4) ELSE 0 END"""

_TRIALS_SQL = f"""
    SELECT trial_no, batch, conc, docs, tokens, docs / greatest(dur, 1e-6) AS docs_s,
           tokens / greatest(dur, 1e-6) AS toks_s, p50 / 1000 AS p50_s, p95 / 1000 AS p95_s, errors, dur
    FROM (SELECT trial_no, batch, conc, CAST(sum(docs) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens,
                 CAST(sum(error) AS BIGINT) AS errors,
                 max(epoch_us(done_at) / 1e6) - min(epoch_us(done_at) / 1e6 - latency_ms / 1000) AS dur
          FROM ({LOG_SQL}) GROUP BY ALL)
    JOIN (SELECT trial_no, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95
          FROM ({_TRIMMED_SQL}) GROUP BY ALL) USING (trial_no)"""

_SHOWN_SQL = """trial_no, batch, conc, docs, tokens, round(docs_s, 6) AS docs_s, round(toks_s, 6) AS toks_s,
    round(p50_s, 6) AS p50_s, round(p95_s, 6) AS p95_s, errors, round(dur, 3) AS dur"""


def _shown(trials):
    digits = {"docs_s": 6, "toks_s": 6, "p50_s": 6, "p95_s": 6, "dur": 3}
    return trials.withColumns({name: F.round(name, d) for name, d in digits.items()})


def _ntz(name):
    return F.col(name).cast("timestamp_ntz").alias(name)


@query(f"SELECT {_SHOWN_SQL} FROM ({_TRIALS_SQL})")
def trial_metrics(spark, sf_dir):
    return _shown(request_log.trial_metrics(log(spark, sf_dir)))


@query(f"""
    SELECT trial_no, batch, conc, count(*) AS requests, CAST(sum(docs) AS BIGINT) AS docs,
           CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(error) AS BIGINT) AS errors,
           CAST(sum(CASE WHEN error = 0 THEN docs ELSE 0 END) AS BIGINT) AS docs_ok
    FROM ({LOG_SQL}) GROUP BY ALL""")
def run_totals(spark, sf_dir):
    return request_log.run_totals(log(spark, sf_dir), request_log.RUN)


_LATENCY_SQL = """count(*) AS n, round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms,
    round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms"""


def _rounded_ms(summary):
    return summary.withColumns({c: F.round(c, 6) for c in summary.columns if c.endswith("_ms")})


@query(f"SELECT {_LATENCY_SQL} FROM ({LOG_SQL})")
def latency_summary(spark, sf_dir):
    return _rounded_ms(request_log.latency_summary(log(spark, sf_dir)))


@query(f"SELECT trial_no, {_LATENCY_SQL} FROM ({LOG_SQL}) GROUP BY ALL")
def latency_by_trial(spark, sf_dir):
    return _rounded_ms(request_log.latency_summary(log(spark, sf_dir), ["trial_no"]))


@query(f"SELECT request_id, trial_no, round(latency_ms, 6) AS latency_ms FROM ({_TRIMMED_SQL})")
def warmup_trim(spark, sf_dir):
    kept = request_log.warmup_trim(log(spark, sf_dir))
    return kept.select("request_id", "trial_no", F.round("latency_ms", 6).alias("latency_ms"))


@query(f"""
    SELECT trial_no, request_id, round(quantile_cont(latency_ms, 0.5) OVER w, 6) AS p50_ms,
           round(quantile_cont(latency_ms, 0.95) OVER w, 6) AS p95_ms
    FROM ({LOG_SQL})
    WINDOW w AS (PARTITION BY trial_no ORDER BY done_at, request_id ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)""")
def rolling_latency(spark, sf_dir):
    rolled = request_log.rolling_latency(log(spark, sf_dir))
    return _rounded_ms(rolled.select("trial_no", "request_id", "p50_ms", "p95_ms"))


ROLLING_TICKS_SQL = f"""
    SELECT trial_no, tick_start, least(2000, pos) AS samples, p50_ms, p95_ms FROM (
      SELECT trial_no, time_bucket(INTERVAL 1 DAY, done_at) AS tick_start,
             row_number() OVER (PARTITION BY trial_no ORDER BY done_at, request_id) AS pos,
             row_number() OVER (PARTITION BY trial_no, time_bucket(INTERVAL 1 DAY, done_at)
                                ORDER BY done_at DESC, request_id DESC) AS back,
             round(quantile_cont(latency_ms, 0.5) OVER w, 6) AS p50_ms,
             round(quantile_cont(latency_ms, 0.95) OVER w, 6) AS p95_ms
      FROM ({LOG_SQL})
      WINDOW w AS (PARTITION BY trial_no ORDER BY done_at, request_id
                   ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)) WHERE back = 1"""


@query(ROLLING_TICKS_SQL)
def rolling_latency_at_ticks(spark, sf_dir):
    rolled = request_log.rolling_latency_at_ticks(log(spark, sf_dir), every_secs=86_400)
    return _rounded_ms(rolled.select("trial_no", _ntz("tick_start"), "samples", "p50_ms", "p95_ms"))


TICKS_SQL = f"""
    SELECT trial_no, make_timestamp(slot * 3600000000) AS tick_start, docs, tokens, errors,
           round(docs / greatest(seen_to - seen_from, 1e-6), 6) AS docs_s,
           round(tokens / greatest(seen_to - seen_from, 1e-6), 6) AS toks_s,
           CAST(sum(docs) OVER w AS BIGINT) AS total_docs,
           round(sum(docs) OVER w / greatest(seen_to - began, 1e-6), 6) AS avg_docs_s
    FROM (SELECT trial_no, slot, began, coalesce(docs, 0) AS docs, coalesce(tokens, 0) AS tokens,
                 coalesce(errors, 0) AS errors, least((slot + 1) * 3600, ended) AS seen_to,
                 CASE WHEN slot = lo THEN began ELSE slot * 3600 END AS seen_from
          FROM (SELECT trial_no, lo, began, ended, unnest(generate_series(lo, hi)) AS slot FROM (
                  SELECT trial_no, min(epoch_us(done_at) // 3600000000) AS lo,
                         max(epoch_us(done_at) // 3600000000) AS hi,
                         min(epoch_us(done_at) / 1e6 - latency_ms / 1000) AS began,
                         max(epoch_us(done_at) / 1e6) AS ended FROM ({LOG_SQL}) GROUP BY ALL))
          LEFT JOIN (SELECT trial_no, epoch_us(done_at) // 3600000000 AS slot, CAST(sum(docs) AS BIGINT) AS docs,
                            CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(error) AS BIGINT) AS errors
                     FROM ({LOG_SQL}) GROUP BY ALL) USING (trial_no, slot))
    WINDOW w AS (PARTITION BY trial_no ORDER BY slot)"""


def _hourly(spark, sf_dir):
    ticks = request_log.interval_rate(log(spark, sf_dir), every_secs=3600)
    return ticks.withColumns({c: F.round(c, 6) for c in ("docs_s", "toks_s", "avg_docs_s")})


@query(f"SELECT trial_no, tick_start, docs, tokens, errors, docs_s, toks_s FROM ({TICKS_SQL})")
def interval_rate(spark, sf_dir):
    return _hourly(spark, sf_dir).select(
        "trial_no", _ntz("tick_start"), "docs", "tokens", "errors", "docs_s", "toks_s"
    )


@query(f"SELECT trial_no, tick_start, total_docs, avg_docs_s FROM ({TICKS_SQL})")
def running_average_rate(spark, sf_dir):
    return _hourly(spark, sf_dir).select("trial_no", _ntz("tick_start"), "total_docs", "avg_docs_s")


def _trials(spark, sf_dir):
    return request_log.trial_metrics(log(spark, sf_dir))


@query(f"SELECT {_SHOWN_SQL} FROM ({_TRIALS_SQL}) WHERE p95_s <= {P95_TARGET} AND errors = 0")
def trials_on_target(spark, sf_dir):
    return _shown(_trials(spark, sf_dir).where(selection.meets_target(P95_TARGET)))


@query(f"""
    SELECT {_SHOWN_SQL} FROM (
      SELECT * FROM ({_TRIALS_SQL}) WHERE p95_s <= {P95_TARGET} AND errors = 0
      ORDER BY toks_s DESC, trial_no LIMIT 1)""")
def best_config(spark, sf_dir):
    return _shown(selection.best_config(_trials(spark, sf_dir), P95_TARGET))


@query(f"SELECT {_SHOWN_SQL.replace('trial_no, ', '')} FROM ({_TRIALS_SQL})")
def trial_csv(spark, sf_dir):
    path = scratch_path(spark, "trials-csv")
    write_trials(_trials(spark, sf_dir), path)
    read = read_trials(spark, path)
    return _shown(read.withColumn("errors", F.col("errors").cast("bigint")))


@query(f"""
    SELECT trial_no, round(toks_s, 6) AS toks_s,
           round(toks_s / (SELECT toks_s FROM ({_TRIALS_SQL}) WHERE trial_no = 1), 6) AS scaling
    FROM ({_TRIALS_SQL})""")
def scaling_factor(spark, sf_dir):
    scaled = selection.scaling_factor(_trials(spark, sf_dir), F.col("trial_no") == 1)
    return scaled.select("trial_no", F.round("toks_s", 6).alias("toks_s"), F.round("scaling", 6).alias("scaling"))


_CORPUS_SQL = f"SELECT count(*) AS docs, avg({estimate_tokens_sql('text')}) AS avg_tok FROM documents"
_ESTIMATE_SQL = f"""
    SELECT trial_no, corpus_docs, avg_tok, toks_s, p95_s, hours, hours * 1.25 AS cost FROM (
      SELECT trial_no, toks_s, p95_s, docs AS corpus_docs, avg_tok,
             docs * avg_tok / toks_s / 3600 AS hours
      FROM ({_TRIALS_SQL.replace(" docs,", " docs AS run_docs,", 1)}),
           (SELECT docs, unnest([15.0::DOUBLE, 64.0::DOUBLE, avg_tok]) AS avg_tok FROM ({_CORPUS_SQL})))"""


def _estimates(spark, sf_dir):
    corpus = table(spark, sf_dir, "documents").agg(
        F.count("*").alias("docs"), F.avg(estimate_tokens(F.col("text"))).alias("avg_tok")
    )
    return selection.capacity_estimate(
        _trials(spark, sf_dir),
        corpus.select("docs").scalar(),
        [15.0, 64.0, corpus.select("avg_tok").scalar()],
        price_per_hour=1.25,
    )


@query(f"""
    SELECT trial_no, corpus_docs, round(avg_tok, 6) AS avg_tok, round(hours, 6) AS hours, round(cost, 6) AS cost
    FROM ({_ESTIMATE_SQL})""")
def capacity_estimate(spark, sf_dir):
    return _estimates(spark, sf_dir).select(
        "trial_no",
        "corpus_docs",
        F.round("avg_tok", 6).alias("avg_tok"),
        F.round("hours", 6).alias("hours"),
        F.round("cost", 6).alias("cost"),
    )


# Every run at every document size is a choice: 1a to 9c.
_CHOICES = [f"{run}{size}" for run in range(1, 10) for size in "abc"]
_CHOICE_SQL = "trial_no || CASE avg_tok WHEN 15 THEN 'a' WHEN 64 THEN 'b' ELSE 'c' END"


@query(" UNION ALL ".join(
    f"SELECT '{metric}' AS metric, "
    + ", ".join(f"""round(max(CASE WHEN {_CHOICE_SQL} = '{c}' THEN {metric} END), 6) AS "{c}\"""" for c in _CHOICES)
    + f" FROM ({_ESTIMATE_SQL})"
    for metric in ("toks_s", "hours", "cost", "p95_s")
))
def cost_compare(spark, sf_dir):
    size = F.when(F.col("avg_tok") == 15, "a").when(F.col("avg_tok") == 64, "b").otherwise("c")
    named = _estimates(spark, sf_dir).withColumn("choice", F.concat(F.col("trial_no").cast("string"), size))
    side_by_side = selection.cost_compare(named, "choice", _CHOICES, ["toks_s", "hours", "cost", "p95_s"])
    return side_by_side.select("metric", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in _CHOICES])
