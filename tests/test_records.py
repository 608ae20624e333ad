from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomvec.sources import records

OK = None
FLOATS = ["1e7", "-2.5e3", "12345678.25", "1e16", "1.5e-7", "0.00012", "1E+22", "-1e-5", "0.1", "1e15", "1e300", "0.0"]
LINES = [
    ('{"_id":{"$oid":"abc"},"text":"hi"}', "abc", OK),
    ('{"_id":{"$oid":"abc","more":1},"text":"hi"}', "abc", OK),
    ('{"_id":5,"text":"x"}', "5", OK),
    ('{"_id":1e3,"text":"x"}', "1000.0", OK),
    ('{"_id":1.50,"text":"x"}', "1.5", OK),
    ('{"_id":12345678901234567890123,"text":"x"}', "12345678901234567890123", OK),
    ('{"_id":true,"text":"x"}', "True", OK),
    ('{"_id":5.0,"text":"x"}', "5.0", OK),
    ('{"_id":-17,"text":"x"}', "-17", OK),
    ('{"_id":9223372036854775808,"text":"x"}', "9223372036854775808", OK),
    *[(f'{{"_id":{x},"text":"x"}}', str(float(x)), OK) for x in FLOATS],
    ('{"_id":{"a":1},"text":"x"}', '{"a":1}', OK),
    ('{"_id":1,"_id":2,"text":"a"}', "2", OK),
    ('{"_id":"x","text":"y","o":{"a":1,"a":2},"n":NaN}', "x", OK),
    ('{"_id":"x","text":null}', "x", OK),
    ('{"_id":"x","text":""}', "x", OK),
    ('  {"_id":"pad","text":"x"} \t', "pad", OK),
    ('{"_id":"x"}', "x", records.NO_TEXT),
    ('{"text":"x"}', None, records.NO_ID),
    ("{}", None, records.NO_ID),
    ('{"_id":null,"text":"x"}', None, records.NULL_ID),
    ('{"_id":NaN,"text":"x"}', "NaN", records.MALFORMED),
    ('{"_id":"x","text":7}', "x", records.TEXT_NOT_STRING),
    ('{"_id":"x","text":["q"]}', "x", records.TEXT_NOT_STRING),
    ("{'_id':1,'text':'a'}", None, records.MALFORMED),
    ('{"_id":1,"text":"a"', None, records.MALFORMED),
    ('{"_id":1,"text":"a"} junk', None, records.MALFORMED),
    ('{"_id":1,"text":"a"}]', None, records.MALFORMED),
    ('{"_id":1,"text":"a"} {"b":2}', None, records.MALFORMED),
    ('{"_id":1,"text":"a"},{"_id":2,"text":"b"}', None, records.MALFORMED),
    ("[1,2]", None, records.MALFORMED),
    ('[{"_id":1,"text":"a"}]', None, records.MALFORMED),
    ("5", None, records.MALFORMED),
    ("null", None, records.MALFORMED),
    ('"_id text"', None, records.MALFORMED),
    ("", None, records.MALFORMED),
]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("records") / "lines.jsonl"
    path.write_text("\n".join(line for line, _, _ in LINES) + "\n")
    return str(path)


def test_each_line_gets_its_verdict(spark, path):
    judged = records.judge_lines(records.read_lines(spark, path))
    found = {row.value: (row.id, row.reason) for row in judged.collect()}
    for line, id_, reason in LINES:
        assert found[line][1] == reason, line
        if reason is OK:
            assert found[line][0] == id_, line


def test_records_and_quarantine_share_out_the_lines(spark, path):
    judged = records.judge_lines(records.read_lines(spark, path))
    good, bad = records.records_of(judged).count(), records.quarantine_of(judged).count()
    assert good == sum(reason is OK for _, _, reason in LINES)
    assert good + bad == len(LINES)


def test_text_may_be_missing_when_not_required(spark, path):
    judged = records.judge_lines(records.read_lines(spark, path), require_text=False)
    row = judged.where(F.col("value") == '{"_id":"x"}').first()
    assert row.reason is None and row.text is None


def test_text_keeps_its_characters(spark, tmp_path):
    file = tmp_path / "one.jsonl"
    file.write_text('{"_id":"u","text":"a\\u00e9\\n\\ud83d\\ude00 \\"q\\""}\n')
    assert records.read_records(spark, str(file)).first().text == 'aé\n😀 "q"'


def test_a_line_is_parsed_once(spark, path):
    plan = records.with_text(records.read_records(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
