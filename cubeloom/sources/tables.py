"""Sinks and the insert-only period history."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cubeloom.functions.numbers import number_column
from cubeloom.operators.audit import audit_of, deep_audit, stored_fact_violations
from cubeloom.operators.facts import (
    SIDE_TOTALS,
    checks_of_totals,
    existing_period_check,
    final_manifests,
    finalize_control,
    finalize_manifests,
    housekeeping_of_totals,
    register_manifests,
    register_pending,
    side_totals,
)
from cubeloom.operators.history import (
    MESSAGES,
    compare_periods,
    fingerprint_of,
    header_row,
    latest_per_key,
    period_results,
    publish_post_checks,
    run_status,
    stored_rollup,
)
from cubeloom.operators.normalize import fact_defaults, staging_projection
from cubeloom.session import materialize, own_step, shuffles_freed
from cubeloom.sources.log import VERSION, VersionedLog, children, remove
from cubeloom.sources.schemas import CONTROL, MANIFESTS, empty_table
from cubeloom.spec import DEFAULT_SPEC, CubeSpec

PARQUET_CODECS = ("zstd", "snappy")


def by_period(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Cluster rows for a period-partitioned write.

    Rebalancing lets AQE split a month that holds most rows and merge small
    ones, so files have an even size and no task writes every month.
    """
    return df.hint("rebalance", F.col(spec.period))


def write_csv(
    df: DataFrame,
    path: str,
    separator: str = ",",
    mode: str = "errorifexists",
    file_rows: int | None = None,
) -> None:
    """Texts are written as they are, blanks at their ends too; null and '' are both empty.

    With ``file_rows`` the files are compressed, so not split, and have no more rows than that.
    """
    packed = {} if file_rows is None else {"compression": "gzip", "maxRecordsPerFile": file_rows}
    writer = df.write.mode(mode).options(
        **packed,
        header="true",
        sep=separator,
        nullValue="",
        emptyValue="",
        escape='"',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    )
    with shuffles_freed(df.sparkSession):
        writer.csv(path)


def write_deep_audit(cube: DataFrame, folder: str, spec: CubeSpec = DEFAULT_SPEC) -> None:
    """Every report of the deep audit as a CSV of its own below ``folder``."""
    for name, report in deep_audit(cube, spec).items():
        write_csv(report, f"{folder}/{name}", mode="overwrite")


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "zstd",
    partition_by: str | None = None,
    mode: str = "errorifexists",
) -> None:
    if codec.lower() not in PARQUET_CODECS:
        raise ValueError(f"codec must be one of {', '.join(PARQUET_CODECS)}")
    writer = df.write.mode(mode).option("compression", codec.lower())
    with shuffles_freed(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_period_table(
    spark: SparkSession, path: str, period: str | None = None, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """A period-partitioned table with its period as text; one period prunes to its folder."""
    stored = spark.read.parquet(path)
    table = stored.withColumn(spec.period, F.col(spec.period).cast("string"))
    return table if period is None else table.filter(F.col(spec.period) == period)


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None while nothing was written to its path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


ATTEMPT = "attempt"
FILES = "path string, length bigint, modified timestamp"


@dataclass
class PeriodTable:
    """Periods below ``path``, each written once and never moved.

    ``data`` holds the rows of every write attempt by period, ``files`` the delivered files that
    an attempt was made of, and ``commits`` a :class:`VersionedLog` with one row per period that
    names the attempt which counts; ``fields`` (DDL) is what else such a row says.  Commit rows
    are written last, so a run that dies in between leaves rows that nobody sees, and of two
    writers of a period one gets it.  Reads name the committed folders, so nothing else is
    listed.
    """

    spark: SparkSession
    path: str
    spec: CubeSpec = DEFAULT_SPEC
    fields: str = "filas bigint"

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def log(self) -> VersionedLog:
        own = f"`{self.spec.period}` string, {self.fields}, {ATTEMPT} string, columns array<string>"
        return VersionedLog(self.spark, f"{self.path}/commits", own)

    def attempt_path(self, attempt: str) -> str:
        return f"{self.data_path}/{ATTEMPT}={attempt}"

    def _files_path(self, attempt: str) -> str:
        return f"{self.path}/files/{ATTEMPT}={attempt}"

    def commits(self) -> DataFrame | None:
        commits = self.log.read().drop(VERSION)
        return None if commits.isEmpty() else commits

    def known(self) -> dict[str, str]:
        """The attempt that counts of every committed period (one row per month)."""
        return {r[0]: r[1] for r in self.log.read().select(self.spec.period, ATTEMPT).collect()}

    def periods(self) -> DataFrame:
        """The committed periods, from the commit rows."""
        return self.log.read().select(self.spec.period)

    def last_period(self) -> str | None:
        return self.log.read().agg(F.max(self.spec.period)).first()[0]

    def write(self, rows: DataFrame, files: DataFrame | None = None) -> str:
        # a letter first, so that it is never read as a number
        attempt = f"a{uuid.uuid4().hex}"
        with shuffles_freed(rows.sparkSession):
            rows.write.option("compression", "zstd").partitionBy(self.spec.period).parquet(
                self.attempt_path(attempt)
            )
        if files is not None:
            files.select(self.spec.period, "path", "length", "modified").write.parquet(
                self._files_path(attempt)
            )
        return attempt

    def written(self, attempt: str, columns: list[str]) -> DataFrame:
        """Rows of one attempt, committed or not; none if it wrote none."""
        rows = read_if_written(self.spark, self.attempt_path(attempt))
        if rows is None:
            fields = ", ".join(f"`{c}` string" for c in columns)
            return self.spark.createDataFrame([], fields)
        return rows.withColumn(self.spec.period, F.col(self.spec.period).cast("string")).select(
            *columns
        )

    def commit(self, periods: DataFrame, attempt: str, columns: list[str]) -> None:
        """Commit the ``periods`` (one row each, with the log's fields) that nobody has by now.

        Nothing is committed to a table of other columns.
        """
        stamped = periods.withColumns(
            {ATTEMPT: F.lit(attempt), "columns": F.array(*[F.lit(c) for c in columns])}
        )

        def decide(log: DataFrame) -> DataFrame:
            first = log.select("columns").first()
            same = first is None or sorted(first[0]) == sorted(columns)
            new = stamped.join(log.select(self.spec.period), self.spec.period, "left_anti")
            return new if same else new.where(F.lit(False))

        self.log.append(decide)

    def columns(self) -> list[str] | None:
        """The stored columns in their order; None before the first commit."""
        first = self.log.read().orderBy(VERSION).select("columns").first()
        return None if first is None else list(first[0])

    def _folder(self, attempt: str, period: str) -> str:
        # Spark escapes what a folder's name cannot hold
        name = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return f"{self.attempt_path(attempt)}/{self.spec.period}={name.escapePathName(period)}"

    def read(self, period: str | list[str] | None = None) -> DataFrame | None:
        """Committed rows of one, some or all periods; None if there are none of them."""
        known = self.known()
        if period is not None:
            wanted = {period} if isinstance(period, str) else set(period)
            known = {p: a for p, a in known.items() if p in wanted}
        if not known:
            return None
        folders = [self._folder(a, p) for p, a in sorted(known.items())]
        rows = self.spark.read.option("basePath", self.data_path).parquet(*folders)
        columns = [c for c in self.columns() if c in rows.columns]
        own = F.col(self.spec.period).cast("string").alias(self.spec.period)
        return rows.select(*[own if c == self.spec.period else F.col(c) for c in columns])

    def files(self) -> DataFrame:
        """(period, path, length, modified): the files that committed periods were made of."""
        stored = read_if_written(self.spark, f"{self.path}/files")
        if stored is None:
            return self.spark.createDataFrame([], f"`{self.spec.period}` string, {FILES}")
        counted = self.log.read().select(ATTEMPT, self.spec.period)
        own = stored.join(counted, [ATTEMPT, self.spec.period], "left_semi")
        return own.select(self.spec.period, "path", "length", "modified")

    def discard(self, attempt: str) -> list[str]:
        """Delete what an attempt wrote and no commit row names: months, or all of it."""
        kept = {p for p, a in self.known().items() if a == attempt}
        if not kept:
            for path in (self.attempt_path(attempt), self._files_path(attempt)):
                remove(self.spark, path)
            return [attempt]
        gone = []
        for entry in children(self.spark, self.attempt_path(attempt)):
            name = entry.getPath().getName()
            period = unquote(name.removeprefix(f"{self.spec.period}="))
            if entry.isDirectory() and period not in kept and name.startswith(self.spec.period):
                remove(self.spark, str(entry.getPath()))
                gone.append(f"{attempt}/{period}")
        return gone

    def discard_uncommitted(self, older_than: float = 0) -> list[str]:
        """Delete the attempts, and months of attempts, that no commit row names; their names.

        Give as ``older_than`` the seconds that a publish of another writer may take: attempts
        begun since then are left alone.
        """
        before, gone = 1000 * (time.time() - older_than), []
        for entry in children(self.spark, self.data_path):
            attempt = entry.getPath().getName().removeprefix(f"{ATTEMPT}=")
            if attempt != entry.getPath().getName() and entry.getModificationTime() <= before:
                gone += self.discard(attempt)
        return gone


@dataclass(frozen=True)
class Published:
    """What one publish did: results per period, fingerprints as read back, rows as written."""

    results: DataFrame
    prints: DataFrame | None = None
    rows_written: int | None = None
    rows_read_back: int | None = None
    refused: str | None = None  # why nothing at all was published


@dataclass
class PeriodHistory:
    """An append-only table of periods; its commit rows keep row count and fingerprint."""

    spark: SparkSession
    path: str
    spec: CubeSpec = DEFAULT_SPEC

    @property
    def table(self) -> PeriodTable:
        counts = [f"sum_{m} bigint" for m in self.spec.fingerprint_counts]
        amounts = [f"sum_{m} string" for m in self.spec.fingerprint_amounts]
        fields = ["row_count bigint", "distinct_analytic_keys bigint", *counts, *amounts]
        fields.append("fingerprint_sha256 string")
        return PeriodTable(self.spark, self.path, self.spec, ", ".join(fields))

    @property
    def data_path(self) -> str:
        return self.table.data_path

    def commits(self) -> DataFrame | None:
        """Committed periods with the fingerprint fields, or None before the first publish."""
        return self.table.commits()

    def read(self, period: str | list[str] | None = None) -> DataFrame:
        rows = self.table.read(period)
        if rows is None:
            raise ValueError(f"no such period was published to {self.path}")
        return rows

    def read_last(self) -> DataFrame:
        """The last period: its name comes from the commit rows, and only its folder is read."""
        return self.read(self.table.last_period())

    def period_counts(self) -> DataFrame:
        """Rows per period as committed; no data is read."""
        return self.table.log.read().select(self.spec.period, F.col("row_count").alias("filas"))

    def _refused(self, rows: DataFrame, message: str) -> Published:
        """Results when nothing of a candidate may be published."""
        counted = (
            rows.where(~header_row(rows))
            .groupBy(self.spec.period)
            .agg(F.count("*").alias("rows_processed"))
        )
        results = counted.select(
            self.spec.period,
            F.lit("failed_processing").alias("status"),
            "rows_processed",
            F.lit(None).cast("bigint").alias("rows_existing"),
            F.lit(0).cast("bigint").alias("rows_loaded"),
            F.lit(None).cast("string").alias("period_fingerprint_hash"),
            F.lit("failed").alias("audit_status"),
            F.lit(message).alias("error"),
        )
        with shuffles_freed(self.spark):
            return Published(materialize(results, "results"), refused=message)

    def _compared_only(self, rows: DataFrame, known: list[str]) -> DataFrame:
        """Rows of ``known`` periods without the values that their comparison does not need."""
        spec = self.spec
        needed = {*spec.keys, *spec.fingerprint_counts, *spec.fingerprint_amounts}
        exists = F.col(spec.period).isin(known)

        def kept(name: str):
            if not known or name in needed:
                return F.col(name)
            lost = exists
            if name.startswith(spec.ratio_prefix):  # the audit looks for infinite ones
                lost = exists & ~F.coalesce(F.abs(number_column(rows, name)) == float("inf"), F.lit(False))
            return F.when(~F.coalesce(lost, F.lit(False)), F.col(name)).alias(name)

        return rows.select(*[kept(c) for c in rows.columns])

    def _publish(
        self,
        candidate: DataFrame,
        expected: DataFrame | None = None,
        files: DataFrame | None = None,
        strict: bool = False,
        period: str | None = None,
        placed: bool = False,
    ) -> Published:
        spec, table = self.spec, self.table
        stored = table.columns()
        if stored is not None:
            if (stored if strict else sorted(stored)) != (
                candidate.columns if strict else sorted(candidate.columns)
            ):
                return self._refused(candidate, MESSAGES["other_columns"])
            candidate = candidate.select(*stored)
        before = table.commits()
        known = sorted(p for p in table.known() if p is not None)
        rows, guards = self._compared_only(candidate, known), Observation()
        rows = own_step(rows) if placed else by_period(rows, spec)
        if strict:
            other = F.lit(False) if period is None else ~F.col(spec.period).eqNullSafe(period)
            # the whole row is only looked at where its period is no period
            header = F.when(F.col(spec.period).eqNullSafe(spec.period), header_row(candidate))
            rows = rows.observe(
                guards,
                F.count(F.lit(1)).alias("rows"),
                F.count_if(header).alias("headers"),
                F.count_if(other).alias("others"),
                F.min(F.when(other, F.col(spec.period))).alias("other"),
            )
        attempt = table.write(rows, files)
        found = guards.get if strict else {"rows": None}
        written = table.written(attempt, candidate.columns)
        refusal = None
        if strict and found["headers"]:
            refusal = MESSAGES["header_row"]
        elif strict and found["others"]:
            many = found["others"] < found["rows"]
            refusal = MESSAGES["multiple_periods"] if many else MESSAGES["other_period"] + str(found["other"])
        elif strict and period is not None and not found["rows"]:
            refusal = MESSAGES["no_rows"]
        if refusal is not None:
            out = self._refused(written, refusal)
            table.discard(attempt)
            return out

        rollup = materialize(stored_rollup(written, spec), "rollup")
        prints = fingerprint_of(rollup, spec)
        audit = audit_of(rollup, candidate.columns, expected, spec)

        def judged(commits: DataFrame | None) -> DataFrame:
            comparison = compare_periods(prints, commits, expected, spec)
            return materialize(period_results(comparison, audit, spec), "results")

        results = judged(before)
        new = {r[0] for r in results.where("status = 'success_loaded'").select(spec.period).collect()}
        if new:
            table.commit(
                prints.where(F.col(spec.period).isin(list(new))).select(*prints.columns),
                attempt,
                candidate.columns,
            )
            own = {p for p, a in table.known().items() if a == attempt}
            if own != new:  # another writer was faster: compare with what it published
                results = self._overtaken(judged(table.commits().where(F.col(ATTEMPT) != attempt)), own)
        table.discard(attempt)
        back = rollup.agg(F.coalesce(F.sum("filas"), F.lit(0))).first()[0] if strict else None
        return Published(results, prints, found["rows"], back)

    def _overtaken(self, results: DataFrame, own: set[str]) -> DataFrame:
        """Periods that are new but were not committed met a history of other columns."""
        lost = (F.col("status") == "success_loaded") & ~F.col(self.spec.period).isin(list(own))
        instead = {
            "status": F.lit("failed_processing"),
            "rows_loaded": F.lit(0).cast("bigint"),
            "error": F.lit(MESSAGES["other_columns"]),
        }
        return materialize(
            results.select(
                *[
                    F.when(lost, instead[c]).otherwise(F.col(c)).alias(c) if c in instead else F.col(c)
                    for c in results.columns
                ]
            ),
            "results",
        )

    def publish(
        self,
        candidate: DataFrame,
        expected: DataFrame | None = None,
        files: DataFrame | None = None,
        placed: bool = False,
    ) -> tuple[DataFrame, DataFrame]:
        """Audit, compare and append the new periods; returns period results and the run summary.

        The candidate is evaluated and written once.  Of periods that the history has, only what
        a comparison with their commit row needs is written, and deleted again; new ones stay
        where they are.  Columns are matched by name; a candidate with others than the history
        is refused before anything is written.  ``files`` (period, path, length, modified) is
        kept with what is committed.  ``placed`` says that each task has rows of few months, as
        from files by month: they are written without a shuffle.  If another writer commits a
        period first, the result says how this candidate compares with it.
        """
        done = self._publish(candidate, expected, files, placed=placed)
        return done.results, run_status(done.results, self.spec)

    def publish_checked(
        self, candidate: DataFrame, period: str | None = None, placed: bool = False
    ) -> DataFrame:
        """Guarded publish; one row of checks per published period.

        The columns must be those of the history in the same order, no row may repeat the
        header, and with ``period`` all rows must belong to it; else nothing is published and
        all periods are ``blocked``.  What the guards need is counted while the rows are written.
        Then the rows read back must be as many as were written, and the commit row as the log
        now has it must agree with them.  ``placed`` as for :meth:`publish`.
        """
        spec = self.spec
        before = materialize(self.period_counts(), "before")
        done = self._publish(candidate, strict=True, period=period, placed=placed)
        if done.refused is not None:
            existing = F.coalesce("filas", F.lit(0).cast("bigint"))
            return done.results.join(before, spec.period, "left").select(
                spec.period,
                existing.alias("rows_before"),
                F.lit(0).cast("bigint").alias("rows_inserted"),
                existing.alias("rows_after"),
                F.lit("blocked").alias("status"),
                F.lit("blocked").alias("validation_status"),
                F.lit(done.refused).alias("error_message"),
            )
        loaded = done.results.filter(F.col("status") == "success_loaded")
        all_there = F.lit(done.rows_written == done.rows_read_back)
        inserted = loaded.select(
            spec.period,
            F.when(all_there, F.col("rows_processed")).alias("expected"),
            F.col("rows_loaded").alias("inserted"),
        )
        prints = done.prints.join(loaded.select(spec.period), spec.period, "left_semi")
        again = compare_periods(prints.select(*done.prints.columns), self.commits(), spec=spec)
        return publish_post_checks(before, inserted, self.period_counts(), again, spec)


class ConstraintError(ValueError):
    """Rows that the facts may not contain; nothing was committed."""


@dataclass
class FactTables:
    """Staging and facts below ``path``, both by period, insert-only and committed.

    A commit row keeps the period's row count, sums and flag counts as they were read back from
    what was written, so reconciliation and housekeeping read no data.  Control rows and run
    manifests are :class:`VersionedLog` tables: every state they had can be read.
    """

    spark: SparkSession
    path: str
    spec: CubeSpec = DEFAULT_SPEC

    def table(self, name: str) -> PeriodTable:
        return PeriodTable(self.spark, f"{self.path}/{name}", self.spec, SIDE_TOTALS)

    @property
    def control_log(self) -> VersionedLog:
        return VersionedLog(self.spark, f"{self.path}/control", CONTROL)

    @property
    def manifest_log(self) -> VersionedLog:
        return VersionedLog(self.spark, f"{self.path}/manifests", MANIFESTS)

    def _read(self, name: str, periods: list[str] | None = None) -> DataFrame:
        empty = empty_table(self.spark, name, self.spec)
        rows = self.table(name).read(periods)
        if rows is None:
            return empty
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema])

    def staging(self, periods: list[str] | None = None) -> DataFrame:
        return self._read("staging", periods)

    def facts(self, periods: list[str] | None = None) -> DataFrame:
        return self._read("facts", periods)

    def totals(self, name: str) -> DataFrame:
        """Row count, sums and flag counts per period of 'staging' or 'facts', as committed."""
        log = self.table(name).log.read()
        return log.drop(ATTEMPT, "columns", VERSION)

    def control(self, as_of: int | None = None) -> DataFrame:
        """The control table: of the rows written for a period, the last one."""
        return self.control_log.latest(self.spec.period, as_of)

    def manifests(self, as_of: int | None = None) -> DataFrame:
        """The last state of every run, now or at a version of the log."""
        return self.manifest_log.latest("run_id", as_of)

    def final_manifests(self, as_of: int | None = None) -> DataFrame:
        """The latest completed manifest of every period, or else the latest one."""
        return final_manifests(self.manifests(as_of), self.spec)

    def register(self, requested: DataFrame, run_id: str) -> None:
        """Pending control rows for requested periods that are new to control and facts."""

        def decide(log: DataFrame) -> DataFrame:
            control = _last(log, self.spec.period)
            existing = existing_period_check(requested, control, self.totals("facts"), self.spec)
            return register_pending(existing, run_id, spec=self.spec)

        self.control_log.append(decide)

    def register_runs(self, wanted: DataFrame) -> None:
        """Pending manifests for (run_id, period) with a control row; a run id is used once."""

        def decide(log: DataFrame) -> DataFrame:
            new = register_manifests(wanted, self.control(), _last(log, "run_id"), self.spec)
            return new.withColumns(
                {
                    "started_at": F.lit(None).cast("timestamp"),
                    "finished_at": F.lit(None).cast("timestamp"),
                    "config_hash_sha256": F.lit(None).cast("string"),
                    "created_at": F.current_timestamp(),
                }
            )

        self.manifest_log.append(decide)

    def checks(self, requested: DataFrame | None = None) -> DataFrame:
        """Staging against facts for every period, from the commit rows."""
        return checks_of_totals(
            self.totals("staging"), self.totals("facts"), self.control(), requested, self.spec
        )

    def finalize(self, run_id: str) -> DataFrame:
        """Mark the promoted periods that pass the checks as loaded; returns the checks."""
        checks = materialize(self.checks(), "checks")

        def decide(log: DataFrame) -> DataFrame:
            control = _last(log, self.spec.period)
            return finalize_control(control, checks, run_id=run_id, spec=self.spec).where("finalized")

        self.control_log.append(decide)
        return checks

    def finalize_runs(self, requested: DataFrame | None = None) -> DataFrame:
        """Complete the pending runs of loaded periods that pass; (run_id, …, reason) of all runs.

        The new state carries the checks in its JSON, and the JSON it had before inside that.
        """
        checks = materialize(self.checks(), "checks")

        def decided(log: DataFrame) -> DataFrame:
            return finalize_manifests(_last(log, "run_id"), checks, requested=requested, spec=self.spec)

        outcome = materialize(decided(self.manifest_log.read()), "runs")
        self.manifest_log.append(lambda log: decided(log).where("finalized"))
        return outcome

    def housekeeping(self, source: DataFrame, requested: DataFrame | None = None) -> DataFrame:
        """Which source periods may be archived; of the stored tables only logs are read."""
        return housekeeping_of_totals(
            source,
            self.totals("staging"),
            self.totals("facts"),
            self.control(),
            self.final_manifests(),
            requested,
            self.spec,
        )

    def _append(self, name: str, rows: DataFrame, check=None) -> None:
        """Write, check what was written, then commit its periods."""
        table = self.table(name)
        attempt = table.write(rows)
        written = table.written(attempt, rows.columns)
        if check is not None:
            check(written)
        totals = materialize(side_totals(written, self.spec), "totals")
        table.commit(totals, attempt, rows.columns)
        table.discard(attempt)

    def load_staging(
        self, source: DataFrame, control: DataFrame, run_id: str, placed: bool = False
    ) -> None:
        """Stage the periods of ``source`` that have a control row and are not staged yet.

        ``placed`` says that each task has rows of few months: they are written without a shuffle.
        """
        controlled = {r[0] for r in control.select(self.spec.period).distinct().collect()}
        if new := sorted(controlled - set(self.table("staging").known())):
            rows = staging_projection(source, run_id, self.spec)
            # literal months: sources by period open these only
            rows = rows.where(F.col(self.spec.period).isin(new))
            self._append("staging", own_step(rows) if placed else by_period(rows, self.spec))

    def promote(self, control: DataFrame) -> None:
        """Promote staged periods without facts; raises and commits nothing on a broken rule."""

        def check(rows: DataFrame) -> None:
            broken = stored_fact_violations(rows, self.spec)
            # at most two rows per period
            found = [f"{r[0]} {r[1]}: {r[2]} rows" for r in broken.orderBy(*broken.columns).collect()]
            if found:
                raise ConstraintError("; ".join(found))

        controlled = {r[0] for r in control.select(self.spec.period).distinct().collect()}
        staged = set(self.table("staging").known()) & controlled
        if new := sorted(staged - set(self.table("facts").known())):
            # the files of a staged month hold that month only, so they are written as they come
            self._append("facts", own_step(fact_defaults(self.staging(new), self.spec)), check)


def _last(log: DataFrame, key: str) -> DataFrame:
    """The last row of each key in a log that was read."""
    return latest_per_key(log, key, [F.col(VERSION).desc()]).drop(VERSION)
