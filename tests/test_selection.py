
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomvec.plans import selection
from loomvec.sources.trials import TRIAL_SCHEMA, read_trials, write_trials

# Batch, conc, docs, tokens, docs_s, toks_s, p50_s, p95_s, errors, dur of published trials.
HOSTED = [
    (8, 16, 6168, 2568544, 246.45464231619383, 102631.2569379711, 0.3933519864999653, 0.6031360247504836, 0, 25.026917496999886),
    (8, 32, 11848, 4912009, 558.2585320426907, 231445.89244771146, 0.4045521120006015, 0.5806305782999513, 0, 21.223141823999867),
    (8, 64, 20000, 8263639, 274.6900338994011, 113496.96385212065, 0.4264754929999981, 0.6458239479998156, 1, 72.80933973499941),
    (16, 16, 6880, 2834689, 125.08158969830907, 51535.96023551018, 0.7276827460000277, 1.0526956210001117, 0, 55.00409785800002),
    (16, 32, 11472, 4757473, 500.7855810575986, 207677.2908534551, 0.8111533709998184, 1.4583118521001777, 0, 22.90800780600057),
    (16, 64, 20000, 8292312, 738.0204765875677, 305994.8027126403, 0.8342670150004778, 1.4308953650999683, 0, 27.0995190980002),
    (32, 16, 7648, 3149282, 314.2879846993863, 129417.03622254872, 1.4296974979993138, 2.0886782761003815, 0, 24.334369662000427),
    (32, 32, 15392, 6407658, 473.63257917400693, 197172.27033556125, 1.4471192849996442, 1.8077363570002487, 1, 32.49776446299984),
    (32, 64, 20000, 8286581, 273.5014845446498, 113319.61026497446, 1.4907198095002059, 2.034991520999938, 2, 73.13412567299998),
]
FOUR_GPU = [
    (32, 128, 15397, 6427094, 174.18844147644225, 72710.62460755947, 21.911809318999076, 25.292025775498587, 0, 88.39277663599933),
    (32, 192, 20000, 8279451, 185.6964661678502, 76873.23962549366, 31.68500780999966, 35.709117442100066, 0, 107.70264191200113),
    (32, 256, 20000, 8261857, 178.247487357077, 73632.76255767391, 42.93786336899939, 47.27233804080097, 0, 112.20354517499982),
    (32, 384, 20000, 8297856, 188.04283204543353, 78017.61710725965, 59.12795138399997, 60.854861804399846, 201, 106.35874700699969),
]


def trials(spark, rows):
    numbered = [(i, *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, f"trial_no int, {TRIAL_SCHEMA}")


def test_best_hosted_configuration(spark):
    best = selection.best_config(trials(spark, HOSTED), 10.0).collect()
    assert [(row.batch, row.conc) for row in best] == [(16, 64)]


def test_target_changes_the_choice(spark):
    best = selection.best_config(trials(spark, HOSTED), 1.0).first()
    assert (best.batch, best.conc) == (8, 32)


def test_no_configuration_fits(spark):
    assert selection.best_config(trials(spark, FOUR_GPU), 10.0).collect() == []
    relaxed = selection.best_config(trials(spark, FOUR_GPU), 40.0).first()
    assert (relaxed.batch, relaxed.conc) == (32, 192)


def test_ties_go_to_the_first_trial(spark):
    same = [HOSTED[0], (64, 1, *HOSTED[0][2:])]
    assert selection.best_config(trials(spark, same), 10.0).first().batch == 8


def test_scaling_factor(spark):
    measured = spark.createDataFrame(
        [(1, 24375.0), (2, 36076.0), (4, 76873.0)], "gpus int, toks_s double"
    )
    scaled = selection.scaling_factor(measured, F.col("gpus") == 1).orderBy("gpus").collect()
    assert [round(row.scaling, 2) for row in scaled] == [1.0, 1.48, 3.15]


def test_capacity_of_four_hundred_million(spark):
    chosen = trials(spark, FOUR_GPU).where("conc = 192")
    hours = selection.capacity_estimate(chosen, 400_000_000, [15, 20, 25, 30, 40, 50, 64], 800 / 730)
    found = {row.avg_tok: round(row.hours, 1) for row in hours.collect()}
    assert found == {15.0: 21.7, 20.0: 28.9, 25.0: 36.1, 30.0: 43.4, 40.0: 57.8, 50.0: 72.3, 64.0: 92.5}


def test_cost_compare(spark):
    options = spark.createDataFrame(
        [("own", 77000.0, 2.1, 56.0), ("hosted", 28000.0, 5.8, 229.0)],
        "choice string, toks_s double, days double, cost double",
    )
    table = selection.cost_compare(options, "choice", ["own", "hosted"], ["toks_s", "days", "cost"])
    found = {row.metric: (row.own, row.hosted) for row in table.collect()}
    assert found == {"toks_s": (77000.0, 28000.0), "days": (2.1, 5.8), "cost": (56.0, 229.0)}


@pytest.mark.parametrize("with_dur", [True, False])
def test_csv_round_trip(spark, tmp_path, with_dur):
    path = str(tmp_path / "trials")
    table = trials(spark, HOSTED)
    write_trials(table, path)
    if not with_dur:
        spark.read.csv(path, header=True).drop("dur").write.mode("overwrite").csv(f"{path}-9", header=True)
        path = f"{path}-9"
    read = read_trials(spark, path, with_dur)
    assert read.drop("dur").exceptAll(table.drop("trial_no", "dur")).count() == 0
    assert read.columns[-1] == "dur" and read.count() == 9
    both = read.unionByName(trials(spark, FOUR_GPU).drop("trial_no"))
    assert both.count() == 13


def test_trials_are_numbered_in_order(spark):
    numbered = selection.number_in_order(trials(spark, HOSTED).drop("trial_no"), ["batch", "conc"])
    assert [row.conc for row in numbered.orderBy("trial_no").collect()] == [16, 32, 64] * 3
