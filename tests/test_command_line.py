from __future__ import annotations

import json

import pytest

from loomvec.__main__ import main
from loomvec.operators.compaction import read_consolidated
from loomvec.sources.shards import read_embeddings


def test_embed_consolidate_verify_report(spark, tmp_path, capsys):
    lines = tmp_path / "in.jsonl"
    lines.write_text("\n".join(json.dumps({"_id": i, "text": f"text {i}"}) for i in range(20)) + "\nbad\n")
    out, packed = str(tmp_path / "out"), str(tmp_path / "packed")
    for _ in range(2):
        main(["embed", "--input", str(lines), "--output", out, "--dims", "8", "--quarantine", str(tmp_path / "bad"), "--log-requests"])
        assert read_embeddings(spark, out).count() == 20
    assert "embedded 0 records, 0 failed" in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "bad")).count() == 1

    main(["consolidate", "--source-dirs", f"{out}/status=ok", "--output-dir", packed, "--ignore-extra"])
    assert read_consolidated(spark, packed).count() == 20
    main(["verify", f"{packed}/wave=00000", "--report", str(tmp_path / "files")])
    shown = capsys.readouterr().out
    assert "embedding: list" in shown and "20 rows, 0 unreadable" in shown
    assert spark.read.json(str(tmp_path / "files")).count() == 1
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no")
    with pytest.raises(SystemExit):
        main(["verify", str(tmp_path / "broken")])
    assert "1 unreadable" in capsys.readouterr().out
    main(["report", "--run-table", out, "--csv", str(tmp_path / "own"), "--p95-target", "100"])
    assert "'batch': 256" in capsys.readouterr().out

    log = str(tmp_path / "log")
    spark.range(100).selectExpr(
        "id AS request_id", "1 AS trial_no", "8 AS batch", "16 AS conc",
        "timestamp_seconds(1700000000 + id) AS done_at", "CAST(id AS DOUBLE) AS latency_ms",
        "8 AS docs", "80L AS tokens", "0 AS error",
    ).write.parquet(log)
    main(["report", "--log", log, "--csv", str(tmp_path / "csv"), "--p95-target", "1"])
    main(["report", "--csv", str(tmp_path / "csv"), "--p95-target", "0.01"])
    shown = capsys.readouterr().out
    assert "'batch': 8" in shown and "none" in shown
