import glob
import os

import pytest
from pyspark.sql import functions as F

from cubeloom.operators import cube as C
from cubeloom.operators.history import multiset_difference
from cubeloom.operators.normalize import derived_sums, measure_rows
from cubeloom.session import fresh_path
from cubeloom.sources.tables import PeriodHistory
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.streaming import ingest
from cubeloom.workload import QUERIES
from cubeloom.workload.landing import write_landing

P = SPEC.period
MONTHS = ("2025-01-31", "2025-02-28", "2025-03-31")


def same(a, b):
    return multiset_difference(a, b).isEmpty() and multiset_difference(b, a).isEmpty()


@pytest.fixture
def raw(raw_row, text_frame):
    values = ("1", "0.1", "0.30000000000000004", "12345678901.25", "<null>", "0.00001")
    rows = [raw_row(**{P: m, "sexo": str(i % 5), "ta": v, "tpu": v, "masa_sal_ta": v, "ta_sal": "3"})
            for m in MONTHS for i, v in enumerate(values * 2)]
    return text_frame([*rows, raw_row(**{P: "<null>"}), raw_row(sexo="<null>")])


def test_a_month_goes_to_as_many_tasks_as_it_has_shares(raw):
    shares = {MONTHS[0]: 3, MONTHS[1]: 1}
    numeric = derived_sums(C.by_key(measure_rows(raw), shares=shares))
    placed = numeric.withColumn("task", F.spark_partition_id())
    tasks = placed.groupBy(P).agg(F.count_distinct("task").alias("n"), F.count_distinct(C.SHARE).alias("s"))
    for month, n, dealt in tasks.collect():
        assert n <= dealt <= shares.get(month, 1)
    assert same(C.sum_to_cube(numeric), C.cube_aggregate(raw))


def test_rows_of_whole_keys_are_a_cube_without_a_shuffle(raw):
    sums = C.cube_aggregate(raw).select(*SPEC.keys, *SPEC.sums).localCheckpoint()
    whole = C.whole_cube(sums)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    assert same(whole, C.merge_cubes(sums))


def test_the_only_partial_of_a_month_is_not_merged(spark, tmp_path, raw_row, monkeypatch):
    monkeypatch.setattr(ingest, "merge_cubes", lambda *_, **__: pytest.fail("merged"))
    row = raw_row(ta="2.5", ta_sal="2", masa_sal_ta="5")
    columns = [c for c in row if c != P]
    for month in MONTHS:
        path = tmp_path / "in" / month / f"asg-{month}.csv"
        os.makedirs(path.parent)
        path.write_text("\n".join(["|".join(columns), *["|".join(row[c] for c in columns)] * 2, ""]), "utf-8")
    history = PeriodHistory(spark, fresh_path(spark, "h"))
    ingest.ingest_available(spark, str(tmp_path / "in"), str(tmp_path / "cp"), history)
    got = history.read().select(P, "ta", "sbc_total").collect()
    assert sorted(tuple(r) for r in got) == [(m, 5.0, 2.5) for m in MONTHS]


def test_landing_files_are_compressed_and_a_month_has_few(spark, sf_dir):
    root = write_landing(spark, sf_dir)
    found = glob.glob(f"{root}/*/asg=*/*.csv.gz")
    assert found and not glob.glob(f"{root}/*/asg=*/*.csv")
    assert len(found) <= len({os.path.dirname(f) for f in found}) + 3 * 8


def test_both_sides_of_a_set_difference_come_from_one_join(spark, sf_dir):
    plan = QUERIES["set_difference_both"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "delivery-" in plan
