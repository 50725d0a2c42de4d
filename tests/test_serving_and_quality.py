from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from timelegs.operators import quality, serving
from timelegs.plans import inspect
from timelegs.schemas import (
    METRIC_VALUE,
    SERVING_MODEL_RESULTS,
    SERVING_PREDICTIONS,
    SERVING_SEGMENTS,
    SERVING_STOPS,
    STOPS,
)
from timelegs.sources import sinks, tables


def ask(network, name, **params):
    return serving.run_query(network.spark, name, network.serving, params)


def busiest(network):
    return ask(network, "busiest_route").first()["line_ref"]


def test_hostile_text_matches_nothing(spark, network):
    row = serving.injection_check(spark, network.serving["segments"]).first()
    assert row["rows_returned_for_malicious_input"] == 0
    assert row["total_segment_records_unchanged"] == network.segments.count()
    assert row["sql_injection_prevented"]


def test_questions_are_plain_text_with_markers():
    for statement in serving.QUERIES.values():
        assert "%s" not in statement and "' +" not in statement


def test_kpis_of_an_unknown_line_are_one_row(network):
    row = ask(network, "route_kpi", line_ref="no such line").first()
    assert row["segment_records"] == 0 and row["average_runtime_minutes"] is None


def test_questions_agree_with_each_other(network):
    line = busiest(network)
    kpi = ask(network, "route_kpi", line_ref=line).first()
    summary = ask(network, "route_summary", line_ref=line).first()
    lookup = ask(network, "route_lookup", line_ref=line).first()
    hourly = ask(network, "route_hourly", line_ref=line).collect()
    assert kpi["segment_records"] == summary["segment_records"] == lookup["matching_records"]
    assert sum(r["record_count"] for r in hourly) == kpi["segment_records"]
    stops = ask(network, "route_stops", line_ref=line)
    assert stops.count() == stops.distinct().count() > 0
    longest = ask(network, "route_longest", line_ref=line, row_limit=3).collect()
    assert len(longest) == 3 and longest[0]["runtime_minutes"] == kpi["maximum_runtime_minutes"]


def test_optional_filters(network):
    everything = ask(
        network, "anomaly_kpis", minimum_error=0.0, line_ref=None, direction=None
    ).first()["anomaly_records"]
    parts = [
        ask(network, "anomaly_kpis", minimum_error=0.0, line_ref=None, direction=d).first()[
            "anomaly_records"
        ]
        for d in ("Longer than expected", "Shorter than expected")
    ]
    assert everything == sum(parts) > 0
    detail = ask(
        network, "anomaly_detail", minimum_error=0.0, line_ref=None, direction=None, row_limit=4
    )
    assert detail.count() == min(4, everything)
    assert "latitude" not in serving.without_coordinates(detail).columns


def test_lookup_filter_reaches_the_scan(spark, network, tmp_path):
    path = str(tmp_path / "segments")
    ids = serving.assign_ids(network.serving["segments"], "segment_id", ["line_ref"])
    sinks.write_parquet(ids, path)
    written = spark.read.parquet(path)
    plan = inspect.plan_text(
        serving.run_query(spark, "route_lookup", {"segments": written}, {"line_ref": "Brand#7"})
    )
    assert "EqualTo(line_ref,Brand#7)" in plan
    assert "ReadSchema: struct<line_ref:string,runtime_minutes:double>" in plan


def test_ids_are_unique_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("line"), "id").repartition(6)
    ids = serving.assign_ids(df, "row_id", ["line", "id"]).collect()
    assert len({r["row_id"] for r in ids}) == 1000
    ordered = sorted(ids, key=lambda r: r["row_id"])
    assert [(r["line"], r["id"]) for r in ordered] == sorted((r["line"], r["id"]) for r in ids)


def test_stop_names_fall_back(spark):
    def stop(ref, official, own):
        return (ref, own, official, None, " t ", 1.0, 2.0, 1, "BCT", "active", "1", "1")

    df = spark.createDataFrame(
        [stop("A", "off", "own"), stop("B", " ", "own"), stop("C", None, ""), stop(" ", "x", "y")],
        STOPS,
    )
    found = {r["stop_ref"]: r for r in serving.serving_stops(df).collect()}
    assert {k: v["stop_name"] for k, v in found.items()} == {"A": "off", "B": "own", "C": "Unknown stop"}
    assert (found["A"]["town"], found["A"]["locality_name"]) == ("t", "")


def test_sample_export(spark):
    df = spark.createDataFrame([(i, f"it's {i}") for i in range(9)], "a int, b string")
    lines = [r[0] for r in serving.sample_export({"t": df}).collect()]
    assert len(lines) == 5 and "INSERT INTO t (a, b) VALUES (0, 'it''s 0');" in lines


# --- rules ---

RULE_BREAKERS = {
    "stops": ({"latitude": 91.0}, {"longitude": -181.0}),
    "segments": (
        {"departure_hour": 24},
        {"is_peak_hour": 2},
        {"distance_km": -0.1},
        {"runtime_minutes": 0.0},
        {"is_iqr_high_duration": -1},
    ),
    "predictions": (
        {"distance_km": -1.0},
        {"actual_runtime_minutes": 0.0},
        {"absolute_error_minutes": -1.0},
        {"is_model_anomaly": 3},
    ),
    "model_results": (
        {"rank_by_rmse": 0},
        {"rmse": -1.0},
        {"mae": -1.0},
        {"training_seconds": -1.0},
        {"evaluation_seconds": -1.0},
    ),
}

VALID = {
    "latitude": 50.0,
    "longitude": 0.5,
    "departure_hour": 8,
    "is_peak_hour": 1,
    "distance_km": 0.5,
    "runtime_minutes": 1.0,
    "is_iqr_high_duration": 0,
    "actual_runtime_minutes": 1.0,
    "absolute_error_minutes": 0.1,
    "is_model_anomaly": 0,
    "rank_by_rmse": 1,
    "rmse": 1.0,
    "mae": 1.0,
    "training_seconds": 1.0,
    "evaluation_seconds": 1.0,
}


@pytest.mark.parametrize("table", sorted(RULE_BREAKERS))
def test_each_rule_finds_its_row(spark, table):
    breakers = RULE_BREAKERS[table]
    names = sorted({k for b in breakers for k in b})
    rows = [tuple({**VALID, **b}[n] for n in names) for b in ({}, *breakers)]
    rows.append(tuple(None for _ in names))  # an unknown value breaks no rule
    df = spark.createDataFrame(
        rows, ", ".join(f"{n} {'int' if isinstance(VALID[n], int) else 'double'}" for n in names)
    )
    found = quality.check_violations(df, quality.RULES[table]).first().asDict()
    assert found == {name: 1 for name in quality.RULES[table]}


def test_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    found = {r["k"]: r["row_count"] for r in quality.pk_violations(df, ["k"]).collect()}
    assert found == {1: 2, None: 1}
    assert quality.null_violations(df, ["k"]).first()["k"] == 1
    parent = spark.createDataFrame([(1,)], "p int")
    assert [tuple(r) for r in quality.orphans(df, "k", parent, "p").collect()] == [(2, 1)]
    assert quality.key_exists(df, "k", 2).first()["found"]
    assert not quality.key_exists(df.limit(0), "k", 2).first()["found"]


def test_contracts_and_expectations(spark):
    df = spark.range(3)
    with pytest.raises(quality.MissingColumnsError, match="lines is missing columns: a, b"):
        quality.require_columns(df, ["id", "b", "a"], "lines")
    assert quality.expect(df, rows=3, columns=1) is df
    with pytest.raises(quality.ExpectationError):
        quality.expect(df, rows=4)
    with pytest.raises(quality.ExpectationError):
        quality.expect(df, columns=2)


# --- files ---


def test_parquet_write_counts_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "p")
    assert sinks.write_parquet(spark.range(7), path, expected_rows=7) == 7
    with pytest.raises(sinks.WriteError, match="expected 8"):
        sinks.write_parquet(spark.range(7), path, expected_rows=8)
    with pytest.raises(sinks.WriteError, match="no records"):
        sinks.write_parquet(spark.range(0), path)


def test_csv_keeps_blanks_and_reads_a_byte_order_mark(spark, raw_row, tmp_path):
    from timelegs.schemas import RAW_SEGMENTS

    df = spark.createDataFrame([raw_row(line_ref="  "), raw_row(service_ref=None)], RAW_SEGMENTS)
    path = str(tmp_path / "raw")
    sinks.write_csv(df, path)
    back = tables.read_raw_segments(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))

    marked = tmp_path / "bom.csv"
    marked.write_bytes("﻿metric,value\nrows,5\nname, x \n".encode())
    metrics = tables.read_metrics(spark, str(marked))
    assert metrics.schema == METRIC_VALUE
    record = tables.metrics_record(metrics).first()
    assert record["rows"] == "5"
    assert tables.metric_value(metrics, "name").first()["value"] == "x"
    assert tables.metric_value(metrics, "absent").first()["value"] is None
    again = spark.createDataFrame([("rows", "9"), ("rows", "10"), ("rows", " ")], METRIC_VALUE).coalesce(1)
    assert tables.metric_value(again, "rows").first()["value"] == "10"


def test_stop_files_load_under_their_layouts(spark, tmp_path):
    from timelegs.schemas import STOP_CATALOGUE

    stop = ("A", "own", "official", None, None, 1.5, 2.5, 1, "BCT", "active", "1", "100")
    for schema, row, read in (
        (STOPS, stop, tables.read_stops),
        (STOP_CATALOGUE, ("A", "n", "l", "1.5", "2.5", "1", "x", "f"), tables.read_stop_catalogue),
    ):
        path = str(tmp_path / read.__name__)
        sinks.write_csv(spark.createDataFrame([row], schema), path)
        back = read(spark, path)
        assert back.schema == schema and [tuple(r) for r in back.collect()] == [row]


def test_exports(spark, tmp_path):
    result = spark.createDataFrame([("L1", 1.0, 2.0)], "line_ref string, latitude double, longitude double")
    sinks.export_result(result, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["line_ref"]
    statements = serving.sample_export({"lines": result})
    sinks.write_statements(statements, str(tmp_path / "sql"))
    [line] = spark.read.text(str(tmp_path / "sql")).collect()
    assert line[0] == "INSERT INTO lines (line_ref, latitude, longitude) VALUES ('L1', 1.0, 2.0);"


def test_metrics_keep_the_column_order(spark):
    record = spark.createDataFrame([(1, "x", None)], "b int, a string, c double")
    rows = [tuple(r) for r in sinks.as_metrics(record).collect()]
    assert rows == [("b", "1"), ("a", "x"), ("c", None)]


def test_missing_inputs_are_named(spark, tmp_path):
    (tmp_path / "there.csv").write_text("a\n1\n")
    gone = str(tmp_path / "gone.csv")
    with pytest.raises(FileNotFoundError, match="gone.csv"):
        tables.check_inputs(spark, [str(tmp_path / "there.csv"), gone])
    tables.check_inputs(spark, [str(tmp_path / "there.csv")])


def test_projection_reaches_the_scan(spark, network):
    df = tables.read_parquet(spark, f"{network.sf_dir}/orders.parquet", ["o_orderkey"])
    assert "ReadSchema: struct<o_orderkey:bigint>" in inspect.plan_text(df)
    with pytest.raises(quality.MissingColumnsError):
        tables.read_parquet(spark, f"{network.sf_dir}/orders.parquet", ["nope"])


def serving_row(table, **changes):
    """A row of a serving table that breaks no rule, but for the changes."""
    columns = {
        "stops": SERVING_STOPS,
        "model_results": SERVING_MODEL_RESULTS,
        "segments": ["segment_id", *SERVING_SEGMENTS],
        "predictions": ["prediction_id", *SERVING_PREDICTIONS],
    }[table]
    numbers = {"segment_id": 1, "prediction_id": 1, "r2": 0.5, "predicted_runtime_minutes": 1.0, "residual_minutes": 0.1}
    return {**{c: VALID.get(c, numbers.get(c, "x")) for c in columns}, **changes}


def serving_tables(spark, **rows):
    out = {}
    for table in quality.PRIMARY_KEYS:
        given = rows.get(table, [serving_row(table)])
        types = {c: {int: "bigint", float: "double", str: "string"}[type(v)] for c, v in serving_row(table).items()}
        ddl = ", ".join(f"{c} {t}" for c, t in types.items())
        out[table] = spark.createDataFrame([tuple(r.values()) for r in given], ddl)
    return out


def test_valid_tables_pass(spark):
    quality.require_constraints(serving_tables(spark))


@pytest.mark.parametrize("table", list(RULE_BREAKERS))
def test_one_bad_row_per_rule_is_named(spark, table):
    rows = [serving_row(table, **change) for change in RULE_BREAKERS[table]]
    rows += [serving_row(table, **{c: None}) for c in quality.NOT_NULL[table]]
    with pytest.raises(quality.ConstraintError) as error:
        quality.require_constraints(serving_tables(spark, **{table: rows}))
    for rule in [*quality.RULES[table], *(f"{c}_null" for c in quality.NOT_NULL[table]), "repeated_key"]:
        assert f"{table}.{rule}: " in str(error.value)


@pytest.mark.parametrize("child, column", [(k[0], k[1]) for k in quality.FOREIGN_KEYS])
def test_unknown_references_are_named(spark, child, column):
    rows = {child: [serving_row(child, **{column: "nowhere"})]}
    with pytest.raises(quality.ConstraintError, match=f"{child}.{column}_unknown: 1 rows"):
        quality.require_constraints(serving_tables(spark, **rows))


def test_a_question_about_a_line_writes_no_table(spark, monkeypatch):
    from timelegs.registry import QUERIES
    from timelegs.sources import sample_network
    from tests.conftest import SF_DIR

    def refused(name, build):
        raise AssertionError(f"{name} is written")

    monkeypatch.setattr(sample_network, "stage", refused)
    for name in ("route_stops", "bound_equality", "route_longest", "route_kpi", "null_violations"):
        QUERIES[name](spark, SF_DIR)


def test_narrowed_tables_hold_only_what_is_asked(spark, network):
    few = network.narrowed("line_ref", "runtime_minutes", "distance_km")
    assert few.enriched_table.columns == ["line_ref", "runtime_minutes", "distance_km"]
    assert few.enriched_table.count() == network.enriched.count()
    assert "from_stop_ref" not in few.predictions_table.columns
