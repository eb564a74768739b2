"""Fingerprints and the insert-only history."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cubeloom.operators import audit as A
from cubeloom.operators import facts as L
from cubeloom.operators import history as H
from cubeloom.operators import normalize as N
from cubeloom.operators.cube import cube_aggregate
from cubeloom.session import fresh_path
from cubeloom.sources.schemas import empty_table
from cubeloom.sources.tables import (
    ConstraintError,
    FactTables,
    PeriodHistory,
    write_csv,
    write_parquet,
)
from cubeloom.spec import DEFAULT_SPEC as SPEC

P = SPEC.period


@pytest.fixture
def cube_of(text_frame, raw_row):
    def build(*rows):
        return cube_aggregate(text_frame([raw_row(**r) for r in rows]))

    return build


def fingerprint(df):
    return H.period_fingerprint(df).first()


def test_fingerprint_is_the_hash_of_sorted_compact_json(cube_of):
    row = fingerprint(cube_of({"ta": "18154906", "masa_sal_ta": "5683478926.29"}))
    fields = {k: v for k, v in row.asDict().items() if k != "fingerprint_sha256"}
    assert fields["sum_masa_sal_ta"] == "5683478926.2900" and fields["sum_ta"] == 18154906
    text = json.dumps(fields, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert row.fingerprint_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_fingerprint_ignores_float_noise_but_not_a_cent(cube_of):
    prints = [
        fingerprint(cube_of({"masa_sal_ta": v})).fingerprint_sha256
        for v in ("5683478926.29", "5683478926.289999", "5683478926.30")
    ]
    assert prints[0] == prints[1] != prints[2]
    assert fingerprint(cube_of({"ta": "2"})) != fingerprint(cube_of({"ta": "3"}))


def test_integer_sums_round_half_to_even(cube_of):
    sums = [fingerprint(cube_of({"ta": v})).sum_ta for v in ("0.5", "1.5", "2.5", "2.51")]
    assert sums == [0, 2, 2, 3]


def test_empty_sums_are_zero_in_the_fingerprint(cube_of):
    row = fingerprint(cube_of({"ta": "", "masa_sal_ta": ""}))
    assert (row.sum_ta, row.sum_masa_sal_ta) == (0, "0.0000")


def test_distinct_keys_count_nulls_as_values(cube_of):
    rows = cube_of({"ptpd": "<null>"}, {"ptpd": "0"})
    row = fingerprint(rows.unionByName(rows))
    assert (row.row_count, row.distinct_analytic_keys) == (4, 2)


def publish(history, cube, expected=None):
    results, summary = history.publish(cube, expected)
    return {r[P]: r.status for r in results.collect()}, summary.first()


def test_publish_is_insert_only_and_idempotent(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    jan, feb = {P: "2025-01-31"}, {P: "2025-02-28"}
    status, run = publish(history, cube_of(jan))
    assert status == {"2025-01-31": "success_loaded"} and run.status == "success"
    status, run = publish(history, cube_of(jan))
    assert status == {"2025-01-31": "already_exists"} and run.status == "success_no_changes"
    status, run = publish(history, cube_of(jan, feb))
    assert status == {"2025-01-31": "already_exists", "2025-02-28": "success_loaded"}
    assert (run.status, run.rows_loaded, run.rows_not_loaded) == ("success", 1, 1)
    status, run = publish(history, cube_of({**jan, "ta": "2"}, {**feb, "sexo": "2"}, feb))
    assert status == {
        "2025-01-31": "conflict_existing_period_hash",
        "2025-02-28": "conflict_existing_period_row_count",
    }
    assert run.status == "failed" and run.periods_conflict == "2025-01-31,2025-02-28"
    assert history.read().count() == 2
    assert history.read("2025-02-28").count() == 1


def test_an_audit_failure_blocks_its_period_only(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    bad, good = cube_of({P: "2025-01-31"}), cube_of({P: "2025-02-28"})
    absent = spark.createDataFrame([("2025-01-31",), ("2025-02-28",), ("2025-03-31",)], "p string")
    status, run = publish(history, bad.unionByName(bad).unionByName(good), absent)
    assert status == {
        "2025-01-31": "failed_audit",
        "2025-02-28": "success_loaded",
        "2025-03-31": "failed_audit",
    }
    assert run.status == "completed_with_warnings"
    assert [r[P] for r in history.read().collect()] == ["2025-02-28"]


def test_rows_of_a_broken_run_are_invisible_and_replaced(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    publish(history, cube_of({P: "2025-01-31"}))
    torn = cube_of({P: "2025-02-28"}, {P: "2025-02-28", "sexo": "2"})
    attempt = history.table.write(torn)  # no commit row
    assert history.read().count() == 1
    publish(history, cube_of({P: "2025-02-28"}))
    assert history.read("2025-02-28").count() == 1
    assert history.table.discard_uncommitted() == [attempt]
    assert history.read().count() == 2


def test_a_candidate_with_other_columns_is_refused(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    publish(history, cube_of({P: "2025-01-31"}))
    for other in (cube_of({P: "2025-02-28"}).withColumn("extra", F.lit(1)), cube_of({P: "2025-02-28"}).drop("tec_sal")):
        results, summary = history.publish(other)
        row = results.first()
        assert (row.status, row.rows_loaded) == ("failed_processing", 0) and "columns" in row.error
        assert summary.first().status == "failed"
    assert history.read().count() == 1
    status, _ = publish(history, cube_of({P: "2025-02-28"}).select(*reversed(cube_of({}).columns)))
    assert status == {"2025-02-28": "success_loaded"}


def test_torn_writes_of_staging_and_facts_are_invisible(spark, cube_of):
    control = spark.createDataFrame([("2025-01-31",)], f"{P} string")
    tables = FactTables(spark, fresh_path(spark, "facts"))
    half = N.staging_projection(cube_of({P: "2025-01-31"}), "torn")
    tables.table("staging").write(half)
    tables.table("facts").write(half)
    assert tables.staging().isEmpty() and tables.facts().isEmpty()
    tables.load_staging(cube_of({P: "2025-01-31"}, {P: "2025-01-31", "sexo": "2"}), control, "run-2")
    tables.promote(control)
    assert {r.run_id for r in tables.staging().collect()} == {"run-2"} and tables.facts().count() == 2


def test_publish_checked(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    rows = history.publish_checked(cube_of({P: "2025-01-31"})).collect()
    assert [(r.rows_before, r.rows_inserted, r.rows_after, r.status) for r in rows] == [
        (0, 1, 1, "success")
    ]


def test_missing_history_blocks_the_plan(cube_of):
    comparison = H.compare_periods(H.period_fingerprint(cube_of({})), None)
    plan = H.publish_plan(comparison).first()
    assert (plan.comparison_status, plan.status, plan.action) == ("missing_concentrado", "blocked", "block")


def test_post_checks_name_what_failed(spark):
    counts = lambda n: spark.createDataFrame([("p", n)], f"{P} string, filas bigint")
    inserted = spark.createDataFrame([("p", 3, 2)], f"{P} string, expected bigint, inserted bigint")
    comparison = spark.createDataFrame([("p", "new_period")], f"{P} string, comparison_status string")
    row = H.publish_post_checks(counts(1), inserted, counts(3), comparison).first()
    assert row.validation_status == "failed" and row.error_message.count(";") == 1


def test_light_audit_reports_layout_errors(cube_of):
    cube = cube_of({}).drop("tec").withColumn("sector_economico_3", F.lit("1"))
    row = A.light_period_audit(cube).first()
    assert row.errors == "missing_columns:tec;forbidden_column:sector_economico_3"
    assert A.light_period_audit(cube_of({})).first().status == "success"


def test_four_duplicate_numbers_differ(spark, cube_of):
    cube = cube_of({}, {"sexo": "2"})
    cube = cube.unionByName(cube.filter("sexo = '1'")).unionByName(cube.filter("sexo = '1'"))
    keys = A.duplicate_keys(cube).first()
    assert (keys.llaves_duplicadas, keys.filas_excedentes) == (1, 2)
    assert A.duplicate_rows_in_groups(cube).first().rows_in_duplicate_groups == 3
    assert A.duplicate_keys(cube_of({})).first().filas_excedentes is None
    skipped = A.duplicate_keys(cube.drop("ptpd")).first()
    assert (skipped.status, skipped.missing_key_columns) == ("skipped_missing_key_columns", "ptpd")


def test_pre_checks_of_a_delivery(spark, cube_of):
    jan, feb = cube_of({P: "2025-01-31"}), cube_of({P: "2025-02-28"})

    def errors(df, columns=None):
        return H.aggregate_pre_checks(df, "2025-01-31", columns).first().errors

    assert errors(jan) == errors(jan, jan.columns) == ""
    assert errors(jan.unionByName(feb)) == "aggregate contains multiple periods"
    assert errors(feb).endswith("requested period: 2025-02-28")
    assert "no data rows" in errors(jan.limit(0)) and "<empty>" in errors(jan.limit(0))
    assert errors(jan.drop("sexo", "ta")).endswith("columns: sexo, ta")
    assert "do not match exactly" in errors(jan, jan.columns[::-1])
    header = spark.createDataFrame([tuple(jan.columns)], jan.columns)
    assert "duplicated header row" in errors(header)


def test_load_and_promote_are_insert_only(spark, cube_of):
    control = spark.createDataFrame([("2025-01-31", "pending")], f"{P} string, status string")
    tables = FactTables(spark, fresh_path(spark, "facts"))
    source = cube_of({P: "2025-01-31", "ptpd": "<null>"}, {P: "2025-02-28"})
    for _ in range(2):
        tables.load_staging(source, control, "run-1")
        tables.promote(control)
    assert [(r[P], r.run_id) for r in tables.staging().collect()] == [("2025-01-31", "run-1")]
    facts = tables.facts().collect()
    assert [(r[P], r.ptpd, r.ta) for r in facts] == [("2025-01-31", "no_disponible", 1.0)]


def test_promotion_refuses_rows_that_break_a_constraint(spark, cube_of):
    control = spark.createDataFrame([("2025-01-31", "pending")], f"{P} string, status string")
    twice = cube_of({P: "2025-01-31", "ptpd": "0"})
    odd = cube_of({P: "2025-01-31", "ptpd": "x"})
    for source, kind in ((twice.unionByName(twice), "unique_analytic_key"), (odd, "accepted_ptpd")):
        tables = FactTables(spark, fresh_path(spark, "facts"))
        tables.load_staging(source, control, "run-1")
        with pytest.raises(ConstraintError, match=kind):
            tables.promote(control)
        assert tables.facts().isEmpty()


def test_empty_tables_have_the_columns_of_the_operators(spark, cube_of):
    staged = N.staging_projection(cube_of({}), "r")
    assert empty_table(spark, "staging").dtypes == staged.dtypes
    existing = L.existing_period_check(
        cube_of({}), empty_table(spark, "control"), cube_of({}).groupBy(P).agg(F.count("*").alias("filas"))
    )
    assert existing.first().recommended_status == "conflict_existing_final_rows_without_control"
    assert L.register_pending(existing).dtypes == empty_table(spark, "control").dtypes
    assert empty_table(spark, "cat_genero").columns == ["sexo", "descripcion", "activo"]


def test_sinks(spark, cube_of):
    cube = cube_of({"ptpd": "<null>"})
    with pytest.raises(ValueError, match="codec"):
        write_parquet(cube, fresh_path(spark, "x"), codec="gzip")
    path = fresh_path(spark, "csv")
    write_csv(cube, path)
    back = spark.read.csv(path, header=True)
    assert back.columns == cube.columns and back.first().ptpd is None
