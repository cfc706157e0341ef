from __future__ import annotations

import uuid

from helpers import NOON, card_rows

from tallywright import cli


def run(*argv):
    cli.main(["--shuffle-partitions", "4", *argv])


def test_fraud_reads_text_timestamps(spark, tmp_path, capsys):
    rows = [("a", "A", NOON, 100.0)] + [(f"b{i}", "A", NOON, 1.0) for i in range(4)]
    rows.append(("bad", "A", NOON, -99.0))
    frame = card_rows(spark, rows).selectExpr("* except (timestamp)", "cast(timestamp as string)")
    columns = cli.CARD_FEED.fieldNames()
    frame.select(*columns).write.csv(str(tmp_path / "feed"))
    run("fraud", "--input", str(tmp_path / "feed"), "--format", "csv")
    printed = capsys.readouterr().out
    assert "input_rows 6, accepted_rows 5, rejected_rows 1" in printed
    lines = [line.split("|")[1:-1] for line in printed.splitlines() if line.startswith("|")]
    cells = [[cell.strip() for cell in line] for line in lines]
    assert ["true", "1", "100.0"] in cells and ["false", "4", "4.0"] in cells


def test_ingest_reports_categories(spark, tmp_path, capsys):
    name = f"cli_tests.t_{uuid.uuid4().hex}"
    run("ingest", "--table", name, "--rows", "800", "--location", str(tmp_path / "t"))
    assert capsys.readouterr().out.count("|100    |") == 8
    assert spark.table(name).count() == 800


def test_stream_counts(spark, sf_small, capsys):
    run("stream", "--folder", sf_small)
    assert "window_start" in capsys.readouterr().out
