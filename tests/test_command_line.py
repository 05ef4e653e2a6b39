from __future__ import annotations

import pytest

from clickloom.__main__ import main
from tests.test_pipeline import GOOD, csv


def test_run_then_report(spark, tmp_path, capsys):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD, GOOD.replace("cart", "purchase"))
    tables = ["--warehouse", str(tmp_path / "tables")]
    inbox = ["--source", str(tmp_path / "in"), "--landing", str(tmp_path / "landing")]
    assert main(["run", *tables, *inbox, "--months", "2019-10", "--publish", "shop"]) == 0
    assert spark.table("shop.fct_events").count() == 2
    for name in ("top-products", "funnel", "sales-by-hour", "sales-by-weekday"):
        assert main(["report", *tables, name]) == 0
    shown = capsys.readouterr().out
    assert "runail" in shown and "Tuesday" in shown
    assert main(["rebuild", *tables]) == 0


def test_failing_check_gives_status_1(tmp_path, capsys):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD.replace(",cart,", ",,"))
    tables = ["--warehouse", str(tmp_path / "tables")]
    inbox = ["--source", str(tmp_path / "in"), "--state", str(tmp_path / "state")]
    assert main(["stream", *tables, *inbox]) == 1
    assert "accepted_values(fct_events.event_type): 1 failures" in capsys.readouterr().out
    assert main(["check", *tables]) == 1


def test_nothing_to_stream(tmp_path):
    (tmp_path / "in").mkdir()
    tables = ["--warehouse", str(tmp_path / "tables")]
    assert main(["stream", *tables, "--source", str(tmp_path / "in"), "--state", str(tmp_path / "state")]) == 0


def test_absent_month_is_skipped(tmp_path):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    tables = ["--warehouse", str(tmp_path / "tables")]
    inbox = ["--source", str(tmp_path / "in"), "--landing", str(tmp_path / "landing")]
    assert main(["run", *tables, *inbox, "--months", "2019-11"]) == 0
    assert not (tmp_path / "tables").exists()


def test_unknown_month_is_refused(tmp_path):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    tables = ["--warehouse", str(tmp_path / "tables")]
    inbox = ["--source", str(tmp_path / "in"), "--landing", str(tmp_path / "landing")]
    with pytest.raises(ValueError, match="YYYY-MM"):
        main(["run", *tables, *inbox, "--months", "2019-Oct"])
