"""What a job leaves on the disks: narrow shuffles, no second one for a write, files freed early."""

import glob

import pytest
from pyspark.sql import functions as F

from cubeloom.functions.text import BETWEEN, MARK, joined_texts, parted_texts
from cubeloom.operators.audit import fact_constraint_violations, stored_fact_violations
from cubeloom.operators.cube import cube_aggregate, merge_cubes, row_shares
from cubeloom.operators.history import period_rollup, stored_rollup
from cubeloom.session import FREED, fresh_path, materialize, shared_dir, shuffles_freed
from cubeloom.sources.tables import PeriodTable, write_csv
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload import QUERIES, history_queries
from cubeloom.workload.landing import write_landing

P = SPEC.period
ODD = (None, "", "a", MARK, BETWEEN, f"{MARK}n", f"{MARK}u", f"{MARK}e", f"a{MARK}{BETWEEN}", "null", " ")


class Seen(Exception):
    pass


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_joined_texts_tell_all_texts_apart_and_come_back(spark):
    pairs = [(a, b) for a in ODD for b in ODD]
    frame = spark.createDataFrame(pairs, "a string, b string").withColumn("j", joined_texts([F.col("a"), F.col("b")]))
    frame = frame.withColumn("s", F.split("j", BETWEEN, -1))
    back = frame.select("a", "b", "j", *[c.alias(n) for c, n in zip(parted_texts(F.col("s"), 2), "xy")]).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in back)
    assert len({r.j for r in back}) == len(pairs)


@pytest.mark.parametrize("shares", [None, {None: 2, "2025-01-31": 3}])
def test_the_texts_of_a_key_travel_as_one(text_frame, raw_row, shares):
    texts = [x or "<null>" for x in ODD if x != ""]
    rows = [raw_row(sexo=t, ptpd=u, ta="2") for t in texts for u in texts] * 2
    rows.append(raw_row(**{P: "<null>"}))
    cube = cube_aggregate(text_frame(rows), shares=shares)
    assert plan(cube).count("Exchange") == 1
    shuffled = plan(cube).split("Exchange hashpartitioning(xxhash64(")[1]
    assert "_key#" in shuffled.split("Scan")[0].split("Project")[1] and "_spread" not in shuffled
    found = {(r[P], r.sexo, r.ptpd): r.ta for r in cube.collect()}
    clean = [None if t == "<null>" else t for t in texts]
    wanted = {("2025-01-31", t, u): 4.0 for t in clean for u in clean} | {(None, "1", "1"): 1.0}
    assert found == wanted
    sums = cube.select(*SPEC.keys, *SPEC.sums)
    assert rows_of(merge_cubes(sums, sums.limit(0), shares=shares).select(*sums.columns)) == rows_of(sums)


def test_a_filter_on_the_period_reaches_the_rows_before_their_shuffle(spark, sf_dir, text_frame, raw_row):
    path = fresh_path(spark, "raw")
    text_frame([raw_row(), raw_row(**{P: "2025-02-28"})]).write.parquet(path)
    cube = cube_aggregate(spark.read.parquet(path)).where(F.col(P) < "2025-02")
    text = plan(cube)
    assert "SortAggregate" in text and "Filter" not in text.split("Exchange")[0]
    assert "Filter" in text.split("Exchange")[1]
    assert [r[P] for r in cube.collect()] == ["2025-01-31"]


def _odd_cube(text_frame, raw_row):
    rows = [raw_row(ta="0.123456"), raw_row(ta="5", ptpd="0"), raw_row(ta="<null>", sexo="<null>", ptpd="2")]
    rows += [raw_row(**{P: "2025-02-28"}, sexo=s, rango_edad=e) for s, e in (("<null>", "7"), ("7", "<null>"))]
    cube = cube_aggregate(text_frame([*rows, raw_row(**{P: "<null>"})]))
    return cube.unionByName(cube.where(F.col(P) == "2025-01-31"))


def test_a_stored_rollup_is_the_rollup_without_a_shuffle_of_whole_rows(spark, text_frame, raw_row):
    once = cube_aggregate(text_frame([raw_row(), raw_row(ptpd="<null>"), raw_row(sexo="<null>")]))
    cube = materialize(_odd_cube(text_frame, raw_row), "t")
    assert rows_of(stored_rollup(cube)) == rows_of(period_rollup(cube))
    assert rows_of(stored_fact_violations(cube)) == rows_of(fact_constraint_violations(cube))
    # keys that no other shares a hash with are not shuffled at all
    assert "sexo" not in plan(stored_rollup(materialize(once, "t")))


def test_rows_whose_null_parts_differ_are_different_keys(spark, text_frame, raw_row):
    stored = materialize(_odd_cube(text_frame, raw_row), "t")
    found = {r.periodo: (r.filas, r.llaves, r.repetidas) for r in stored_rollup(stored).collect()}
    assert found == {"2025-01-31": (6, 3, 6), "2025-02-28": (2, 2, 0), None: (1, 1, 0)}


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}


def test_shuffle_files_of_a_write_are_gone_when_it_is_written(spark):
    before, own = _shuffle_files(spark), spark.conf.get(FREED, None)
    with shuffles_freed(spark):
        materialize(spark.range(1000).repartition(4), "t")
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(FREED, None) == own


@pytest.mark.parametrize(
    "name",
    [
        "control_lifecycle",
        "housekeeping_stored",
        "insert_only_history",
        "manifest_lifecycle",
        "publish_column_guard",
        "publish_header_guard",
        "publish_post_checks",
        "stored_snapshot",
        "history_period_scan",
    ],
)
def test_a_cube_is_written_by_period_without_another_shuffle(spark, sf_dir, monkeypatch, name):
    def seen(*args, **kwargs):
        raise Seen(plan(next(a for a in args if hasattr(a, "columns"))))

    # fields of a dataclass have no columns, its rows do
    monkeypatch.setattr(PeriodTable, "write", lambda self, rows, files=None: seen(rows))
    monkeypatch.setattr(history_queries, "write_parquet", seen)
    with pytest.raises(Seen) as found:
        QUERIES[name](spark, sf_dir)
    assert "REBALANCE" not in str(found.value)


def test_staged_months_are_promoted_as_they_lie(spark, sf_dir, monkeypatch):
    written, write = [], PeriodTable.write

    def seen(self, rows, files=None):
        written.append(plan(rows))
        if len(written) == 2:
            raise Seen(written[1])
        return write(self, rows, files)

    monkeypatch.setattr(PeriodTable, "write", seen)
    with pytest.raises(Seen) as found:
        QUERIES["control_lifecycle"](spark, sf_dir)
    assert "Exchange" not in str(found.value) and "no_disponible" in str(found.value)


def test_a_landing_keeps_its_files_only(spark, sf_dir):
    before = set(glob.glob(f"{shared_dir(spark)}/rows-*"))
    write_landing(spark, sf_dir)
    assert set(glob.glob(f"{shared_dir(spark)}/rows-*")) <= before


def test_csv_files_are_compressed_if_their_rows_are_limited(spark):
    path = fresh_path(spark, "csv")
    write_csv(spark.range(10).coalesce(1), path, file_rows=4)
    assert len(glob.glob(f"{path}/*.csv.gz")) == 3
    assert spark.read.csv(path, header=True).count() == 10


def test_a_month_has_a_share_for_each_so_many_rows(spark, monkeypatch):
    monkeypatch.setattr("cubeloom.operators.cube.SHARE_ROWS", 3)
    rows = spark.createDataFrame([("a",)] * 7 + [("b",)] * 3 + [(None,)], f"`{P}` string")
    assert row_shares(rows) == {"a": 3, "b": 1, None: 1}
