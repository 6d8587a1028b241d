from __future__ import annotations

import json
import os

import pytest

from panelworks import sinks, sources
from panelworks.operators.clean import clean
from panelworks.operators.validate import rejected_rows
from panelworks.schema import DIMENSION_SCHEMA, PanelSpec
from tests.conftest import panel_rows, rows_of


def record(**change) -> str:
    row = {
        "region": "Birch Vale",
        "federal_district": "Inland",
        "year": 2017,
        "indicator": "life_expectancy",
        "value": 77.25,
        "collected_at": "2023-05-06T07:08:09Z",
        **change,
    }
    return json.dumps({k: v for k, v in row.items() if v is not ...}, ensure_ascii=False)


def panel_texts() -> list[str]:
    names = ["region", "federal_district", "year", "indicator", "value", "collected_at"]
    return [
        json.dumps({**dict(zip(names, r)), "collected_at": "2024-01-01T00:00:00Z"},
                   ensure_ascii=False)
        for r in panel_rows()
    ]


# --- scans -------------------------------------------------------------------


def test_load_skips_service_rows_and_blank_lines(spark, lines):
    service = record(indicator="_agg_life_expectancy", federal_district="window", year=0)
    path = lines(*panel_texts(), service, "")
    df = sources.load_raw(spark, path)
    assert df.count() == 48
    assert df.first().collected_at.year == 2024


def test_blank_and_white_lines_between_rows(spark, lines):
    path = lines(record(), "", "   ", record(year=2021))
    assert sources.load_raw(spark, path).count() == 2


def test_one_service_row_and_one_normal(spark, lines):
    assert sources.load_raw(spark, lines(record(indicator="_agg_x"), record())).count() == 1


def test_bad_lines_fail_drop_or_stay(spark, lines):
    path = lines(record(), '{"region": "Bir')
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.load_raw(spark, path).collect()
    assert sources.load_raw(spark, path, on_bad="drop").count() == 1
    kept = sources.load_raw(spark, path, on_bad="keep")
    assert [r._corrupt_record for r in kept.where("region is null").collect()] == [
        '{"region": "Bir'
    ]


def test_input_order_follows_the_file(spark, lines):
    texts = [record(region=f"r{i % 7}", value=float(i)) for i in range(200)]
    df = sources.load_raw(spark, lines(*texts), numbered=True).repartition(5)
    got = clean(df, PanelSpec(order=("seq",)))
    assert rows_of(got, "region", "value") == [(f"r{i}", float(i)) for i in range(7)]


def test_first_records(spark, lines):
    path = lines(*[record(value=float(i)) for i in range(50)])
    got = sources.first_records(spark, path, 5).collect()
    assert [r.value for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert sources.first_records(spark, path, 500).count() == 50


@pytest.mark.parametrize(
    "text, kept",
    [
        (record(), True),
        (record(region=42), False),
        (record(year="2020"), False),
        ('{"year": 2020.0}', False),
        ('{"year": true}', False),
        ('{"value": 7}', True),
        ('{"value": "7"}', False),
        (record(collected_at="yesterday"), False),
        (record(region=None, year=None, value=None), True),
        ("{}", True),
        ("null", True),
        ("[]", False),
        ("{cut", False),
        (record(indicator="_agg_x"), False),
    ],
)
def test_lenient_lines(spark, text, kept):
    df = spark.createDataFrame([(text,)], "value string")
    assert (sources.lenient_records(df).count() == 1) is kept


def test_lenient_scan_fills_zero_values(spark, lines):
    path = lines('{"indicator": "x"}', "", "broken", record())
    rows = rows_of(sources.scan_lenient(spark, path).drop("collected_at"),
                   "region", "federal_district", "year", "indicator", "value")
    assert rows == [("", "", 0, "x", 0.0), ("Birch Vale", "Inland", 2017, "life_expectancy", 77.25)]


def test_dimension_from_one_array(spark, lines):
    path = lines("[", '  {"name": "Birch Vale", "federal_district": "Inland"},',
                 '  {"name": "Dune Plain", "federal_district": "Delta"}', "]", name="regions.json")
    df = sources.read_dimension(spark, path, DIMENSION_SCHEMA)
    assert rows_of(df, "name", "federal_district") == [("Birch Vale", "Inland"), ("Dune Plain", "Delta")]


# --- newest dataset ----------------------------------------------------------


def place(root, name: str, when: int, text: str = "{}"):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    os.utime(path, (when, when))


def found(spark, root):
    return sources.latest_dataset(spark, str(root)).first().dataset


def test_newest_file_wins(spark, tmp_path):
    place(tmp_path, "raw.ndjson", 1_000)
    place(tmp_path, "deep/er/clean.parquet", 2_000)
    assert found(spark, tmp_path) == "deep/er/clean.parquet"


def test_service_files_are_skipped(spark, tmp_path):
    place(tmp_path, "raw.ndjson", 1_000)
    for i, name in enumerate(
        ["aggregated.ndjson", "rejected.ndjson", "a_bench.parquet", "smoke.parquet",
         "aggregated.ndjson2/x.txt"]
    ):
        place(tmp_path, name, 2_000 + i)
    assert found(spark, tmp_path) == "raw.ndjson"


def test_folder_datasets_count_as_one(spark, tmp_path):
    place(tmp_path, "old.parquet", 1_000)
    place(tmp_path, "run/new.ndjson/part-0.json", 3_000)
    place(tmp_path, "rejected.ndjson/part-0.json", 4_000)
    assert found(spark, tmp_path) == "run/new.ndjson"


def test_no_file(spark, tmp_path):
    place(tmp_path, "notes.txt", 1_000)
    assert found(spark, tmp_path) is None
    assert sources.load_latest(spark, str(tmp_path)) is None


def test_load_latest_reads_either_format(spark, tmp_path, panel_small):
    place(tmp_path, "raw.ndjson", 1_000, "\n".join([record(), record(indicator="_agg_x")]))
    assert sources.load_latest(spark, str(tmp_path)).count() == 1
    sinks.write_parquet(panel_small, str(tmp_path / "clean.parquet"))
    assert sources.load_latest(spark, str(tmp_path)).count() == 48


def test_empty_panel(spark):
    assert sources.empty_panel(spark).count() == 0


# --- sinks -------------------------------------------------------------------


def test_ndjson_appends_and_makes_parents(spark, tmp_path, panel_small):
    path = str(tmp_path / "a" / "b" / "raw.ndjson")
    sinks.append_ndjson(panel_small, path)
    sinks.append_ndjson(panel_small, path)
    sinks.append_ndjson(panel_small.where("false"), path)
    assert spark.read.json(path).count() == 96


def test_parquet_is_zstd_and_skips_empty(spark, tmp_path, panel_small):
    path = tmp_path / "clean.parquet"
    assert sinks.write_parquet(panel_small.where("false"), str(path)) is False
    assert not path.exists()
    assert sinks.write_parquet(panel_small, str(path)) is True
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(path))
    assert spark.read.parquet(str(path)).count() == 48


def test_layout_by_indicator_prunes(spark, tmp_path, panel_small):
    path = str(tmp_path / "by.parquet")
    sinks.write_by_indicator(panel_small, path)
    part = spark.read.parquet(path).where("indicator = 'population'")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(indicator" in plan
    assert part.count() == 8
    assert all(len(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("ind"))


def test_hot_indicator_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "hot.parquet")
    rows = spark.range(200_000).selectExpr("'hot' as indicator", "rand(1) as value")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200k")
    try:
        sinks.write_by_indicator(rows, path)
    finally:
        spark.conf.unset(size)
    files = [f for f in os.listdir(f"{path}/indicator=hot") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(path).count() == 200_000


def test_rejected_sink(spark, tmp_path, panel_small):
    path = tmp_path / "rejected.ndjson"
    good = rejected_rows(panel_small)
    assert sinks.write_rejected(good, str(path)) is False and not path.exists()
    bad = rejected_rows(panel_small.selectExpr("* except (year)", "1L as year"))
    assert sinks.write_rejected(bad, str(path)) is True
    row = spark.read.json(str(path)).first()
    assert row.record.year == 1 and row.errors == ["year: 1 not in [1990, 2030]"]


def test_aggregates_go_next_to_the_raw_output(spark, tmp_path):
    raw = str(tmp_path / "data" / "raw.ndjson")
    assert sinks.aggregated_path(raw) == str(tmp_path / "data" / "aggregated.ndjson")
    sinks.append_aggregates(spark.range(3), raw)
    sinks.append_aggregates(spark.range(2), raw)
    assert spark.read.json(sinks.aggregated_path(raw)).count() == 5


def test_messages(spark, panel_small):
    row = sinks.to_messages(panel_small).where("key = 'Birch Vale'").orderBy("value").first()
    body = json.loads(row.value)
    assert list(body) == ["region", "federal_district", "year", "indicator", "value",
                          "collected_at"]
    assert body["region"] == row.key and body["collected_at"] == "2024-01-01T00:00:00.000000Z"
    assert sinks.to_messages(panel_small.where("false")).count() == 0


def test_messages_can_be_parsed_back(spark, panel_small):
    texts = sinks.to_messages(panel_small).select("value")
    back = sources.parse_messages(texts)
    columns = ["region", "federal_district", "year", "indicator", "value", "collected_at"]
    assert rows_of(back, *columns) == rows_of(panel_small, *columns)


def test_unreadable_messages_are_skipped_or_marked(spark):
    texts = [record(), "{cut", "", "[1", '{"year": "x"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert sources.parse_messages(df).count() == 1
    marked = sources.parse_messages(df, keep_bad=True)
    assert sorted(r.bad for r in marked.collect()) == [False] + [True] * 5


def test_sink_switch(spark, tmp_path, panel_small):
    path = str(tmp_path / "out.ndjson")
    sinks.write_to(panel_small, sinks.SinkSpec("file", path))
    assert spark.read.json(path).count() == 48
    with pytest.raises(ValueError):
        sinks.write_to(panel_small, sinks.SinkSpec("pigeon"))


def test_broker_options():
    options = sources.broker_options("h:1", group="g", max_per_trigger=10)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "10"
    assert sinks.broker_sink_options(sinks.SinkSpec("kafka"))["kafka.acks"] == "1"


def test_folder_names_do_not_hide_a_dataset(spark, tmp_path):
    folder = tmp_path / "smoke_runs"
    folder.mkdir()
    (folder / "raw.ndjson").write_text("{}\n")
    (tmp_path / "rejected.ndjson").write_text("{}\n")
    assert sources.latest_dataset(spark, str(tmp_path)).first().dataset == "smoke_runs/raw.ndjson"
