"""What keeps wide queries in proportion to their input."""

import pytest
from pyspark.sql import functions as F

from cubeloom.functions.numbers import rests
from cubeloom.operators.cube import cube_aggregate, merge_cubes
from cubeloom.operators.history import period_rollup
from cubeloom.session import METHOD_LIMIT, split_large_methods
from cubeloom.sources.tables import PeriodHistory
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload import QUERIES
from cubeloom.workload.star_cube import star_cube


class Seen(Exception):
    pass


def test_a_chain_of_dimensions_is_joined_before_the_rows_meet_it(spark, sf_dir):
    rows = star_cube(spark, sf_dir, ("cve_delegacion", "ta"))
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    order = [text.index(key) for key in ("(l_orderkey#", "(o_custkey#", "(c_nationkey#")]
    assert order == sorted(order)


@pytest.mark.parametrize("name", ["insert_only_history", "publish_post_checks"])
def test_a_cube_that_is_delivered_twice_is_aggregated_once(spark, sf_dir, monkeypatch, name):
    def publish(self, candidate, *args, **kwargs):
        raise Seen(candidate._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(PeriodHistory, "publish", publish)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, sf_dir)
    assert "HashAggregate" not in str(seen.value)


def test_queries_split_large_methods_unless_the_session_says_otherwise(spark, sf_dir):
    own = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.set(METHOD_LIMIT, "65535")
        QUERIES["cube_aggregate"](spark, sf_dir)
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        spark.conf.set(METHOD_LIMIT, "4000")
        split_large_methods(spark)
        assert spark.conf.get(METHOD_LIMIT) == "4000"
    finally:
        spark.conf.set(METHOD_LIMIT, own)


def test_only_rows_with_a_value_beyond_units_carry_rests(spark):
    rows = spark.createDataFrame([(1, 1.5, None), (2, 0.12345, 2.0), (3, None, 2e7)], "i int, a double, b double")
    found = rows.select("i", rests([F.col("a"), F.col("b")]).alias("r")).orderBy("i").collect()
    texts = [r.r and [None if x is None else float(x) for x in r.r] for r in found]
    assert texts == [None, [0.12345, None], [None, 2e7]]


def _sorted_sums(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortAggregate" in plan and "HashAggregate" not in plan


def test_wide_sums_of_keys_are_made_in_sorted_runs_and_not_in_hash_maps(spark, text_frame, raw_row):
    rows = [
        raw_row(ta="10", masa_sal_ta="0.123456"),
        raw_row(ta="5", masa_sal_ta="2"),
        raw_row(ta="1", ptpd="<null>"),
        raw_row(ta="2", ptpd="<null>"),
        raw_row(ta="4", ptpd="0"),
    ]
    cube = cube_aggregate(text_frame(rows))
    assert _sorted_sums(cube)
    assert _sorted_sums(merge_cubes(cube.select(*SPEC.keys, *SPEC.sums).limit(9).localCheckpoint()))
    found = {r.ptpd: (r.ta, r.masa_sal_ta) for r in cube.collect()}
    assert found["0"][0] == 4.0 and found[None][0] == 3.0
    assert (15.0, 2.123456) in found.values()


def test_a_period_rollup_sorts_its_keys_and_counts_null_keys(spark, text_frame, raw_row):
    cube = cube_aggregate(text_frame([raw_row(), raw_row(ptpd="<null>")])).select(*SPEC.keys, *SPEC.sums)
    twice = cube.unionByName(cube)
    rollup = period_rollup(twice)
    assert "SortAggregate" in rollup._jdf.queryExecution().executedPlan().toString()
    assert [(r.filas, r.llaves, r.repetidas) for r in rollup.collect()] == [(4, 2, 4)]
