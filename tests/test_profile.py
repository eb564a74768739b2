"""Profiles, back-fill rules and month-end calendars on small inputs."""

import pytest
from pyspark.sql import functions as F

from cubeloom.operators import backfill as B
from cubeloom.operators import profile as PR
from cubeloom.plans import series
from cubeloom.spec import DEFAULT_SPEC as SPEC

P = SPEC.period


@pytest.fixture(scope="module")
def people(spark):
    rows = [("a", 1.0), ("A ", 2.0), ("nan", None), (None, 4.0), ("a", 1.0), (None, 4.0), ("", 1.0)]
    return spark.createDataFrame(rows, "name string, n double")


def test_column_profile_finds_ghost_values(people):
    rows = {r.columna: r for r in PR.column_profile(people).collect()}
    name, n = rows["name"], rows["n"]
    assert (name.valores_nulos, name.nunique_raw, name.nunique_normalizado) == (2, 4, 1)
    assert (name.valores_fantasma, name.porcentaje_nulos) == (3, 28.57)
    assert name.top_valores == "<null>=4; A=3"
    assert (n.min, n.max, n.media, n.nunique_raw, n.top_valores) == (1.0, 4.0, 2.17, 3, None)


def test_duplicates_treat_null_as_a_value(people):
    assert PR.duplicated_rows(people).count() == 4
    row = PR.table_profile(people).first()
    assert (row.total_registros, row.registros_duplicados, row.valores_nulos_total) == (7, 2, 3)


def test_shares_are_of_all_rows(people):
    rows = {r.valor: r.porcentaje for r in PR.value_counts(people, ["name"], k=1).collect()}
    assert rows == {"a": pytest.approx(200 / 7)}


def test_null_counts_are_sorted_and_limited(people):
    assert [tuple(r) for r in PR.null_counts(people, top=1).collect()] == [("name", 2)]


def test_source_profile_counts_all_distinct_values(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("d"), F.lit("x").alias("ta"))
    dim, number = PR.source_profile(df, ["d"], ["ta"]).orderBy("columna").collect()
    assert (dim.distinct_count, dim.sample_values.count(",")) == (12_000, 9)
    assert (number.numeric_parse_errors, number.sum, number.min) == (12_000, 0.0, None)
    few = PR.source_profile(df, ["d"], [], samples=3).first()
    assert few.sample_values == "0,1,10" and few.non_empty_count == 12_000


def test_profile_of_large_and_infinite_numbers(spark):
    df = spark.createDataFrame([(1e15, float("inf")), (3e15, 2.0), (1e15, None)], "a double, b double")
    rows = {r.columna: r for r in PR.column_profile(df).collect()}
    assert (rows["a"].media, rows["a"].no_finitos) == (1666666666666666.75, 0)
    assert (rows["b"].media, rows["b"].max, rows["b"].no_finitos) == (2.0, 2.0, 1)


def test_month_end_calendar(spark):
    got = [r[0] for r in B.month_end_calendar(spark, "2023-12-31", "2024-03-31").collect()]
    assert got == ["2023-12-31", "2024-01-31", "2024-02-29", "2024-03-31"]
    for start, end in (("2024-01-30", "2024-02-29"), ("2024-01-31", "2024-02-28")):
        with pytest.raises(ValueError, match="month-end"):
            B.month_end_calendar(spark, start, end)
    with pytest.raises(ValueError, match="after"):
        B.month_end_calendar(spark, "2024-03-31", "2024-02-29")


@pytest.mark.parametrize(
    "raw, control, status, rows, action",
    [
        (True, True, "loaded", 5, "skip_existing"),
        (True, True, "loaded", 0, "blocked_inconsistent_state"),
        (True, True, "pending", 0, "blocked_existing_pending"),
        (True, True, "failed_load", 0, "blocked_existing_non_loaded"),
        (True, False, None, 5, "blocked_partial_final"),
        (True, True, None, 0, "blocked_inconsistent_state"),
        (True, False, None, 0, "validate_process_load"),
        (False, False, None, 0, "download_process_load"),
    ],
)
def test_batch_rules(spark, raw, control, status, rows, action):
    calendar = spark.createDataFrame([("2025-01-31",)], f"{P} string")
    files = calendar if raw else calendar.limit(0)
    schema = (
        f"{P} string, period_control_exists boolean, period_control_status string, "
        "final_table_row_count bigint"
    )
    existing = spark.createDataFrame([("2025-01-31", control, status, rows)], schema)
    row = B.batch_plan(calendar, files, existing).first()
    assert (row.recommended_action, row.blocked) == (action, action.startswith("blocked"))


def test_batch_select_takes_any_number(spark):
    plan = spark.createDataFrame([("2025-01-31", "validate_process_load", False)], f"{P} string, recommended_action string, blocked boolean")
    assert B.batch_select(plan, 1).first().selected
    assert B.batch_select(plan, 40).first().selected
    with pytest.raises(ValueError, match="at least 1"):
        B.batch_select(plan, 0)


def test_year_over_year_counts_rows_and_not_months(spark):
    days = [f"2023-{m:02d}-01" for m in range(1, 13) if m != 6] + ["2024-01-01", "2024-02-01"]
    df = spark.createDataFrame([(d, float(i + 1)) for i, d in enumerate(days)], "d string, asegurados double")
    out = series.yoy_change(df.select(F.col("d").cast("date").alias("periodo"), "asegurados"))
    changes = [r.yoy_pct for r in out.orderBy("periodo").collect()]
    # June 2023 is missing, so the row 12 before February 2024 is January 2023
    assert changes[:12] == [None] * 12 and changes[12] == pytest.approx((13 / 1 - 1) * 100)
