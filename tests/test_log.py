"""Logs that several writers share, and what the stored tables keep in them."""

import os

import pytest
from pyspark.sql import functions as F

from cubeloom.operators.cube import cube_aggregate
from cubeloom.session import fresh_path
from cubeloom.sources.log import VersionedLog, put_if_absent
from cubeloom.sources.tables import PeriodHistory, PeriodTable
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.streaming.ingest import file_states

P = SPEC.period


@pytest.fixture
def cube_of(text_frame, raw_row):
    def build(*rows):
        return cube_aggregate(text_frame([raw_row(**r) for r in rows]))

    return build


def test_a_number_is_taken_once(spark):
    path = fresh_path(spark, "log") + "/1.json"
    assert put_if_absent(spark, path, "a") and not put_if_absent(spark, path, "b")
    with open(path) as file:
        assert file.read() == "a"
    assert os.listdir(os.path.dirname(path)) == ["1.json"]


def test_a_slower_writer_decides_again(spark):
    log = VersionedLog(spark, fresh_path(spark, "log"), "k string, n bigint, t timestamp")
    row = lambda k, n: spark.createDataFrame([(k, n)], "k string, n bigint").withColumn(
        "t", F.lit("2025-01-31 10:11:12.123456").cast("timestamp")
    )
    seen = []

    def decide(rows):
        seen.append(rows.count())
        if len(seen) == 1:  # another writer is faster
            assert log.append(lambda _: row("a", 1)) == 1
        return row("a", 2).join(rows, "k", "left_anti").unionByName(row("b", 3))

    assert log.append(decide) == 2 and seen == [0, 1]
    assert {(r.k, r.n) for r in log.latest("k").collect()} == {("a", 1), ("b", 3)}
    assert log.append(lambda _: row("a", 9)) == 3
    assert {(r.k, r.n) for r in log.latest("k").collect()} == {("a", 9), ("b", 3)}
    assert {(r.k, r.n) for r in log.latest("k", as_of=2).collect()} == {("a", 1), ("b", 3)}
    assert log.read().first().t.microsecond == 123456
    assert log.append(lambda rows: rows.drop("version").where("false")) is None


def test_of_two_publishes_of_a_month_one_is_told_of_the_conflict(spark, cube_of, monkeypatch):
    path = fresh_path(spark, "t")
    jan, feb = {P: "2025-01-31"}, {P: "2025-02-28"}
    slow, fast = PeriodHistory(spark, path), PeriodHistory(spark, path)
    commit, done = PeriodTable.commit, []

    def overtaken(self, *args):
        if not done:
            done.append(True)
            fast.publish(cube_of({**jan, "ta": "5"}))
        commit(self, *args)

    monkeypatch.setattr(PeriodTable, "commit", overtaken)
    results, _ = slow.publish(cube_of(jan, feb))
    status = {r[P]: (r.status, r.rows_loaded) for r in results.collect()}
    assert status == {
        "2025-01-31": ("conflict_existing_period_hash", 0),
        "2025-02-28": ("success_loaded", 1),
    }
    assert {(r[P], r.ta) for r in slow.read().collect()} == {("2025-01-31", 5.0), ("2025-02-28", 1.0)}
    # what lost is not left behind: a folder for each committed month
    folders = [f for _, names, _ in os.walk(slow.data_path) for f in names if f.startswith(P)]
    assert sorted(folders) == [f"{P}=2025-01-31", f"{P}=2025-02-28"]


def test_known_months_leave_no_folder_and_reads_open_committed_ones_only(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    jan, feb = {P: "2025-01-31"}, {P: "2025-02-28"}
    history.publish(cube_of(jan))
    history.publish(cube_of(jan, feb))
    folders = [f for _, names, _ in os.walk(history.data_path) for f in names if f.startswith(P)]
    assert sorted(folders) == [f"{P}=2025-01-31", f"{P}=2025-02-28"]
    assert [r[P] for r in history.read_last().collect()] == ["2025-02-28"]
    opened = history.read_last().inputFiles()
    assert opened and all(f"{P}=2025-02-28" in f for f in opened)
    torn = history.table.write(cube_of({P: "2025-03-31"}, feb))
    assert len(history.read().inputFiles()) == 2
    assert history.table.discard_uncommitted(older_than=3600) == []
    assert history.table.discard_uncommitted() == [torn]


def test_states_of_files(spark):
    def files(*rows):
        made = spark.createDataFrame([(*r, "2025-01-01") for r in rows], f"{P} string, path string, length bigint, m string")
        return made.select(P, "path", "length", F.col("m").cast("timestamp").alias("modified"))

    seen = files(("jan", "a", 1), ("jan", "b", 1), ("feb", "c", 1), ("jan", "e", 1))
    landed = files(("jan", "a", 1), ("jan", "b", 1), ("feb", "c", 2), ("jan", "e", 3))
    committed = files(("jan", "a", 1), ("jan", "d", 1), ("jan", "e", 1))
    got = {(r.path, r[P], r.published, r.state) for r in file_states(seen, landed, committed).collect()}
    assert got == {
        ("a", "jan", True, "same"),
        ("b", "jan", True, "late"),
        ("c", "feb", False, "changed"),
        ("d", "jan", True, "gone"),
        ("e", "jan", True, "changed"),
    }


def test_guarded_publish_of_one_period(spark, cube_of):
    history = PeriodHistory(spark, fresh_path(spark, "t"))
    both = cube_of({P: "2025-01-31"}, {P: "2025-02-28"})
    for candidate, message in (
        (both, "aggregate contains multiple periods"),
        (both.where(f"{P} = '2025-02-28'"), "does not match requested period: 2025-02-28"),
    ):
        rows = history.publish_checked(candidate, period="2025-01-31").collect()
        assert {r.status for r in rows} == {"blocked"} and all(message in r.error_message for r in rows)
    assert history.commits() is None and not os.listdir(history.data_path)
    rows = history.publish_checked(both.where(f"{P} = '2025-01-31'"), period="2025-01-31").collect()
    assert [(r[P], r.status, r.rows_after) for r in rows] == [("2025-01-31", "success", 1)]
