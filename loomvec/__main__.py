"""Command line for ``spark-submit``: embed, consolidate, verify, report.

    python -m loomvec embed --input in.jsonl --output out --endpoints http://host/embed
    python -m loomvec consolidate --source-dirs a b --output-dir packed
    python -m loomvec verify packed/wave=00000
    python -m loomvec report --log requests.parquet --csv trials.csv --p95-target 10
"""

from __future__ import annotations

import argparse
import os
import sys
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomvec.operators.compaction import compact
from loomvec.operators.embed import embed_records, prepare_texts
from loomvec.operators.providers import HashingProvider, HttpProvider, inputs_payload, text_payload
from loomvec.operators.request_log import trial_metrics
from loomvec.operators.resume import resume_pending
from loomvec.functions.text import truncate_tokens
from loomvec.operators.verify import file_report
from loomvec.plans.selection import best_config
from loomvec.session import build_session, drop_scratch, materialise, path_exists
from loomvec.sources.records import judge_lines, quarantine_of, read_lines, records_of
from loomvec.sources.shards import read_embeddings, read_request_log, write_embeddings
from loomvec.sources.trials import read_trials, write_trials


def _embed(spark: SparkSession, args: argparse.Namespace) -> None:
    judged = judge_lines(read_lines(spark, *args.input), require_text=not args.text_optional)
    if args.quarantine:
        # Lines are parsed once; both outputs are read from the written verdicts.
        judged = materialise(judged, "judged")
        quarantine_of(judged).write.mode("overwrite").json(args.quarantine)
    records = prepare_texts(records_of(judged), clean=not args.no_clean)
    if args.max_tokens:
        records = records.withColumn("text", truncate_tokens(F.col("text"), args.max_tokens))
    if path_exists(spark, args.output):
        records = resume_pending(records, read_embeddings(spark, args.output))
    endpoints = args.endpoints or []
    provider = partial(HashingProvider, args.dims)
    if endpoints:
        payload = text_payload if args.payload == "text" else inputs_payload
        provider = partial(HttpProvider, payload, os.environ.get(args.token_env), args.timeout)
    embedded = embed_records(
        records,
        provider,
        endpoints,
        batch_size=args.batch_size,
        max_attempts=args.attempts,
        retry_wait=args.retry_wait,
        in_flight=args.in_flight,
        partitions=args.partitions,
        normalize=args.normalize,
        log_requests=args.log_requests,
    )
    done = write_embeddings(embedded, args.output)
    print(f"embedded {done['ok']} records, {done['failed']} failed")


def _consolidate(spark: SparkSession, args: argparse.Namespace) -> None:
    done = compact(
        spark,
        args.source_dirs,
        args.output_dir,
        files_per_chunk=args.chunk_size,
        target_bytes=args.target_mb << 20,
        layout=args.layout,
        ignore_extra=args.ignore_extra,
    )
    if not done.files:
        print("nothing to consolidate")
    print(f"{done.files} files in {done.chunks} chunks; rows {done.rows_written} of {done.rows_expected}")
    rejects = f"{args.output_dir}/_rejects"
    done.rejects.write.mode("append").json(rejects)
    print(f"{spark.read.schema(done.rejects.schema).json(rejects).count()} rejected files are listed in {rejects}")


def _verify(spark: SparkSession, args: argparse.Namespace) -> None:
    report = materialise(file_report(spark, *args.paths), "report")
    if args.report:
        report.write.mode("overwrite").json(args.report)
    done = report.agg(
        F.count("*").alias("files"), F.count_if(~F.col("readable")).alias("bad"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).first()
    for kind in report.where("readable").groupBy("columns").agg(F.count("*").alias("n")).toLocalIterator():
        print(f"{kind.n} files of {kind.columns}")
    for bad in report.where("not readable").toLocalIterator():
        print(f"unreadable: {bad.path}: {bad.error}")
    print(f"{done.files} files, {done.rows} rows, {done.bad} unreadable")
    if done.bad:
        sys.exit(1)


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.log or args.run_table:
        log = spark.read.parquet(args.log) if args.log else read_request_log(spark, args.run_table, args.batch_size, args.in_flight)
        trials = materialise(trial_metrics(log, args.warmup_secs, args.trial_secs), "trials")
        write_trials(trials, args.csv)
    else:
        trials = read_trials(spark, args.csv).selectExpr("*", "monotonically_increasing_id() AS trial_no")
    print(f"{trials.count()} trials in {args.csv}")
    best = best_config(trials, args.p95_target).collect()
    print(f"best under p95 <= {args.p95_target} s: {best[0].asDict() if best else 'none'}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loomvec", description=__doc__.splitlines()[0])
    parser.add_argument("--work-dir", help="folder for intermediate tables that the driver and all executors share")
    commands = parser.add_subparsers(required=True)

    embed = commands.add_parser("embed", help="JSONL records to an embedding table; resumes")
    embed.add_argument("--input", nargs="+", required=True)
    embed.add_argument("--output", required=True)
    embed.add_argument("--endpoints", nargs="+", help="URLs; without any, the hashing provider is used")
    embed.add_argument("--payload", choices=["inputs", "text"], default="inputs")
    embed.add_argument("--token-env", default="EMBED_TOKEN", help="variable that holds the bearer token")
    embed.add_argument("--timeout", type=float, default=120.0)
    embed.add_argument("--dims", type=int, default=64, help="size of hashed vectors")
    embed.add_argument("--no-clean", action="store_true", help="embed texts as they are")
    embed.add_argument("--text-optional", action="store_true", help="records without text are no rejects")
    embed.add_argument("--quarantine", help="folder for rejected lines")
    embed.add_argument("--batch-size", type=int, default=256)
    embed.add_argument("--in-flight", type=int, default=4, help="open requests per task")
    embed.add_argument("--attempts", type=int, default=3)
    embed.add_argument("--retry-wait", type=float, default=5.0)
    embed.add_argument("--partitions", type=int)
    embed.add_argument("--normalize", action="store_true")
    embed.add_argument("--max-tokens", type=int, help="shorten texts, for services that do not")
    embed.add_argument("--log-requests", action="store_true", help="keep a row per request, for report --run-table")
    embed.set_defaults(run=_embed)

    consolidate = commands.add_parser("consolidate", help="many small shards to few large files; resumes")
    consolidate.add_argument("--source-dirs", nargs="+", required=True)
    consolidate.add_argument("--output-dir", required=True)
    consolidate.add_argument("--chunk-size", type=int, default=10_000)
    consolidate.add_argument("--target-mb", type=int, default=1024)
    consolidate.add_argument("--layout", choices=["packed", "chunks"], default="packed")
    consolidate.add_argument("--ignore-extra", action="store_true", help="accept files with more columns")
    consolidate.set_defaults(run=_consolidate)

    verify = commands.add_parser("verify", help="rows and columns of each file, from its footer")
    verify.add_argument("paths", nargs="+")
    verify.add_argument("--report", help="folder for the report on every file (JSON)")
    verify.set_defaults(run=_verify)

    report = commands.add_parser("report", help="trial metrics of a request log, and the best configuration")
    report.add_argument("--log", help="request log (Parquet); without it the CSV is read")
    report.add_argument("--run-table", help="output of embed --log-requests, instead of a log")
    report.add_argument("--batch-size", type=int, default=256, help="of the run table's run")
    report.add_argument("--in-flight", type=int, default=4, help="of the run table's run")
    report.add_argument("--csv", required=True)
    report.add_argument("--p95-target", type=float, default=10.0)
    report.add_argument("--warmup-secs", type=float, default=3.0)
    report.add_argument("--trial-secs", type=float, default=20.0)
    report.set_defaults(run=_report)

    args = parser.parse_args(argv)
    spark = build_session()
    if args.work_dir:
        spark.conf.set("spark.checkpoint.dir", args.work_dir)
    try:
        args.run(spark, args)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1:])
