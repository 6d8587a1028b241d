from __future__ import annotations

import json

import pytest

from panelworks import session
from panelworks.operators.clean import clean
from panelworks.plans.analyze import analyze, flagship, reports
from panelworks.plans.dashboard import dashboard
from panelworks.schema import DEMOGRAPHIC_RULES, PanelSpec
from panelworks.sources import load_raw
from tests.conftest import rows_of


def with_faults(panel):
    """One rejected row, one later copy and one row without a value."""
    wrong = panel.where("region = 'Birch Vale' and indicator = 'birth_rate' and year = 2022")
    return panel.unionByName(
        wrong.selectExpr("* except (year, value)", "2021L as year", "500D as value")
    ).unionByName(
        wrong.selectExpr("* except (value, seq)", "99D as value", "seq + (1L << 40) as seq")
    ).unionByName(wrong.selectExpr("* except (value)", "cast(null as double) as value"))


def test_whole_run(spark, tmp_path, panel_small):
    out, rejected = str(tmp_path / "clean.parquet"), str(tmp_path / "rejected.ndjson")
    run = analyze(spark, with_faults(panel_small), out, rejected)
    assert spark.read.parquet(out).count() == 48
    (row,) = spark.read.json(rejected).collect()
    assert row.errors == ["value: 500 not in [0.0, 100.0] for birth_rate"]
    assert json.loads(json.dumps(row.record.asDict()))["year"] == 2021
    assert run.by_group.count() == 24
    assert rows_of(run.by_group, "federal_district", "indicator", "sum", "count") == rows_of(
        flagship(with_faults(panel_small), DEMOGRAPHIC_RULES),
        "federal_district", "indicator", "sum", "count",
    )


def test_clean_run_writes_no_rejected_file(spark, tmp_path, panel_small):
    rejected = tmp_path / "rejected.ndjson"
    run = analyze(spark, panel_small, rejected_output=str(rejected))
    assert not rejected.exists()
    assert run.rejected.count() == 0 and run.valid.columns[0] == "region"


def test_unreadable_lines_are_rejected_with_their_text(spark, tmp_path):
    path = tmp_path / "raw.ndjson"
    good = '{"region":"Birch Vale","year":2020,"indicator":"birth_rate","value":10.5}'
    path.write_text(f'{good}\n{{cut\n{good.replace("2020", "2021")}\n', encoding="utf-8")
    raw = load_raw(spark, str(path), on_bad="keep", numbered=True)
    run = analyze(spark, raw, rejected_output=str(tmp_path / "rej.ndjson"),
                  spec=PanelSpec(order=("seq",)))
    assert run.valid.count() == 2 and "_corrupt_record" not in run.valid.columns
    (row,) = run.rejected.collect()
    assert row.record._corrupt_record == "{cut" and row.errors == ["record: malformed"]
    assert spark.read.json(str(tmp_path / "rej.ndjson")).count() == 1


def test_report_frames(panel_small):
    got = reports(clean(panel_small), "life_expectancy", 2023, 2019)
    assert {k: v.count() for k, v in got.items()} == {
        "average_since": 20,
        "top_slice": 4,
        "dynamics": 8,
        "histogram": 40,
    }


def test_dashboard_frames(panel_small):
    got = dashboard(panel_small, "birth_rate", (2022, 2023), ["Inland", "Upland"], 2023)
    assert got["kpi_total"].first().total == pytest.approx(11_800_000.2)
    assert got["kpi_negative"].first().n == 2
    assert got["year_slice"].count() == 2
    assert [r.score for r in got["top_scored"].collect()] == [1.0, 0.0]


def test_shared_folder_comes_from_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.shared_root(spark) == root
    first, second = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert first != second and first.startswith(root)


def test_command_line_analyze_and_fetch(spark, tmp_path, panel_small, capsys):
    from panelworks.__main__ import main

    raw, out = str(tmp_path / "raw.ndjson"), str(tmp_path / "clean.parquet")
    panel_small.drop("seq").write.json(raw)
    main(["analyze", "--input", raw, "--output", out, "--rejected", str(tmp_path / "rej.ndjson")])
    assert spark.read.parquet(out).count() == 48
    main(["fetch", "--source", out, "--year-from", "2023"])
    shown = capsys.readouterr().out
    assert "Dune Plain" in shown and "federal_district" in shown
