"""Plan checks: what is scanned, joined and ranked, and that Python stays out of the data path."""

import re

import pytest
from pyspark.sql import functions as F

from cubeloom.operators import audit as A
from cubeloom.operators import facts as L
from cubeloom.operators.cube import cube_aggregate
from cubeloom.session import fresh_path, materialize
from cubeloom.sources.tables import read_period_table, write_parquet
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload import QUERIES
from cubeloom.workload.star_cube import star_cube

P = SPEC.period
# these write tables or files first, their results are plain scans
WRITERS = {
    "insert_only_history",
    "publish_post_checks",
    "publish_column_guard",
    "publish_header_guard",
    "incremental_ingest",
    "late_files",
    "stored_snapshot",
    "manifest_lifecycle",
}
HEADERS = {"layout_resolution", "raw_file_report", "layout_report"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython", text)
    assert ("MapInPandas" in text) == (name in HEADERS)


def test_marts_join_only_the_tables_of_their_columns(spark, sf_dir):
    text = plan(QUERIES["mart_sector1"](spark, sf_dir))
    assert "part.parquet" in text and "orders.parquet" not in text
    assert "l_partkey" in text and "l_suppkey" not in text


def test_reports_of_one_rollup_scan_what_they_sum(spark, sf_dir):
    rollup = A.audit_rollup(star_cube(spark, sf_dir, (P, "ptpd", *SPEC.measures)))
    text = plan(A.flag_distribution(rollup))
    assert text.count("FileScan") == 1
    assert "l_extendedprice" in text and "l_tax" not in text


def test_one_aggregate_shuffle_per_cube(spark, sf_dir):
    path = fresh_path(spark, "raw")
    write_parquet(star_cube(spark, sf_dir), path)
    text = plan(cube_aggregate(spark.read.parquet(path)))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert "SortAggregate" not in text


def test_a_period_prunes_to_its_folder(spark, sf_dir):
    path = fresh_path(spark, "t")
    write_parquet(star_cube(spark, sf_dir, (P, "sexo", "ta")), path, partition_by=P)
    text = plan(read_period_table(spark, path, "1998-06-30").select("ta"))
    assert re.search(r"PartitionFilters: \[[^\]]*1998-06-30", text)
    assert "ReadSchema: struct<ta:double>" in text


def test_top_k_is_limited_before_the_shuffle(spark, sf_dir):
    for name in ("top_values_per_column", "value_counts_top3", "latest_completed_manifest"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, sf_dir))


def test_wide_rows_are_not_shuffled_to_find_new_periods(spark, sf_dir):
    rows = star_cube(spark, sf_dir, (P, "sexo", "ta"))
    path = fresh_path(spark, "t")
    write_parquet(rows, path)
    stored = spark.read.parquet(path)
    periods = materialize(stored.select(P).distinct(), "periods")
    text = plan(L.rows_to_stage(stored, periods, periods.filter(F.col(P) < "1997")))
    assert "SortMergeJoin" not in text and "LeftAnti" in text
