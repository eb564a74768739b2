"""Identity of periods, comparison with a history, and set-based publish decisions."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeloom.functions.numbers import (
    REST,
    UNITS_PER_ONE,
    joined_units,
    number_column,
    rest,
    sum_in_limbs,
    units,
)
from cubeloom.session import materialize, shuffles_freed
from cubeloom.spec import DEFAULT_SPEC, CubeSpec


# The texts of failed checks before and after a publish.
MESSAGES = {
    "missing_columns": "Aggregate file is missing required columns: ",
    "multiple_periods": "aggregate contains multiple periods",
    "other_period": "aggregate period does not match requested period: ",
    "header_row": "aggregate file contains a duplicated header row",
    "no_rows": "aggregate file has no data rows",
    "other_columns": "aggregate and concentrado columns do not match exactly",
    "not_found_after": "post-publish comparison did not return already_exists",
    "other_row_count": "rows_inserted does not match expected aggregate row_count",
    "other_total": "row count after append does not match expected total",
    "other_period_count": "post-publish period row_count does not match aggregate",
}


def period_rollup(
    cube: DataFrame, declared: str | None = None, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """Everything a fingerprint and a period audit need, one row per period.

    Rows are combined per analytic key first: that finds repeated keys, counts
    distinct ones without a second pass and spreads a month that holds most of
    the rows.  ``declared`` names the column with the period a row was delivered
    for (default: the period column itself).  Unused columns are pruned.
    """
    keys = [k for k in spec.keys if k in cube.columns]
    ratios = [c for c in cube.columns if c.startswith(spec.ratio_prefix)]
    measures = (*spec.fingerprint_counts, *spec.fingerprint_amounts)
    infinite = {f"inf_{c}": F.abs(number_column(cube, c)) == F.lit(float("inf")) for c in ratios}

    unit = [] if declared is None else [F.col(declared).alias("periodo")]
    plain, others = {m: f"{m}__units" for m in measures}, {m: f"{m}__rest" for m in measures}
    own = [k for k in keys if k != spec.period]
    month = [F.col(spec.period).alias("_period")] if spec.period in keys else []
    # sorted by a hash, not held in a hash map: see sum_to_cube
    named = [F.col(declared)] if unit else []
    dealt = cube.withColumn("_spread", F.xxhash64(*named, *[F.col(k) for k in keys])).repartition("_spread")
    per_key = dealt.groupBy("_spread", *unit, *month, *own).agg(
        *([F.first(spec.period).alias(spec.period)] if month else []),
        F.count("*").alias("cnt"),
        *[F.sum(units(number_column(cube, m))).alias(n) for m, n in plain.items()],
        *[F.sum(rest(number_column(cube, m))).alias(n) for m, n in others.items()],
        *[F.count_if(c).alias(n) for n, c in infinite.items()],
    )
    if declared is None:
        per_key = per_key.withColumn("periodo", F.col(spec.period))
    found = F.col(spec.period) if spec.period in keys else F.lit(None).cast("string")
    # two steps, so that the period lists are built from a handful of rows
    pairs = per_key.groupBy("periodo", found.alias("_found")).agg(
        F.sum("cnt").alias("filas"),
        F.count("*").alias("llaves"),
        F.sum(F.when(F.col("cnt") > 1, F.col("cnt")).otherwise(0)).alias("repetidas"),
        *[sum_in_limbs(F.col(n)).alias(n) for n in plain.values()],
        *[F.sum(n).alias(n) for n in others.values()],
        *[F.sum(n).alias(n) for n in infinite],
    )
    return _of_pairs(pairs, list(infinite), spec)


def rows_of_crowded_keys(rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """Rows of a stored table whose key shares its 64-bit hash with another row; None if no two do.

    All rows of a repeated key are among them (null counts as a value), so repeated keys are
    counted exactly while only hashes are shuffled, and whole keys of these few rows.  The table
    is scanned twice.
    """
    # a hash leaves nulls out, so which parts are null is hashed beside them
    absent = reduce(lambda a, b: a + b, [F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)])
    hashed = rows.withColumn("_spread", F.xxhash64(*keys, absent))
    counted = hashed.select("_spread").repartition("_spread").groupBy("_spread").agg(F.count("*").alias("n"))
    with shuffles_freed(rows.sparkSession):
        crowded = materialize(counted.where("n > 1").select("_spread"), "crowded")
    return None if crowded.isEmpty() else hashed.join(crowded, "_spread", "left_semi")


def stored_rollup(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """:func:`period_rollup` of a stored cube, whose columns are cheap to scan one by one.

    Sums are combined per period where the rows are read; only hashes of the keys are shuffled.
    """
    ratios = [c for c in cube.columns if c.startswith(spec.ratio_prefix)]
    measures = (*spec.fingerprint_counts, *spec.fingerprint_amounts)
    infinite = {f"inf_{c}": F.abs(number_column(cube, c)) == F.lit(float("inf")) for c in ratios}
    by_month = [F.col(spec.period).alias("periodo"), F.col(spec.period).alias("_found")]
    pairs = cube.groupBy(*by_month).agg(
        F.count("*").alias("filas"),
        F.count("*").alias("llaves"),
        F.lit(0).cast("bigint").alias("repetidas"),
        *[sum_in_limbs(units(number_column(cube, m))).alias(f"{m}__units") for m in measures],
        *[F.sum(rest(number_column(cube, m))).alias(f"{m}__rest") for m in measures],
        *[F.count_if(c).alias(n) for n, c in infinite.items()],
    )
    keys = [k for k in spec.keys if k in cube.columns]
    crowded = rows_of_crowded_keys(cube, keys)
    if crowded is not None:
        repeated = crowded.groupBy("_spread", *keys).agg(F.count("*").alias("cnt")).where("cnt > 1")
        more = repeated.groupBy(*by_month).agg(
            F.sum(1 - F.col("cnt")).alias("llaves"), F.sum("cnt").alias("repetidas")
        )
        pairs = pairs.unionByName(more, allowMissingColumns=True)
    return _of_pairs(pairs, list(infinite), spec)


def _of_pairs(pairs: DataFrame, infinite: list[str], spec: CubeSpec) -> DataFrame:
    """The rollup from rows per period and period found in it."""
    measures = (*spec.fingerprint_counts, *spec.fingerprint_amounts)
    plain, others = {m: f"{m}__units" for m in measures}, {m: f"{m}__rest" for m in measures}
    return pairs.groupBy("periodo").agg(
        F.sum("filas").alias("filas"),
        F.sum("llaves").alias("llaves"),
        F.sum("repetidas").alias("repetidas"),
        F.array_sort(F.collect_set("_found")).alias("found"),
        *[
            F.coalesce(joined_units(F.sum(plain[m]), F.sum(others[m])), F.lit(0)).cast(REST).alias(m)
            for m in measures
        ],
        *[F.sum(n).alias(n) for n in infinite],
    )


def period_fingerprint(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Row count, sums, distinct keys and a SHA-256 of them, for every period."""
    return fingerprint_of(period_rollup(cube, spec=spec), spec)


def fingerprint_of(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    def exact_value(name: str) -> Column:
        # the whole and the fraction of the units apart, as their product has too many digits
        whole = F.floor(name).cast("decimal(26,0)")
        part = F.round(F.col(name) - whole, 0).cast("decimal(26,0)")
        return ((whole + part) * F.lit(Decimal(1) / UNITS_PER_ONE)).cast("decimal(38,4)")

    def whole(name: str) -> Column:
        return F.bround(exact_value(name), 0).cast("bigint")  # half to even, as Python's round

    def amount(name: str) -> Column:
        return exact_value(name).cast("string")

    fields = {
        spec.period: F.col("periodo"),
        "row_count": F.col("filas"),
        "distinct_analytic_keys": F.col("llaves"),
        **{f"sum_{m}": whole(m) for m in spec.fingerprint_counts},
        **{f"sum_{m}": amount(m) for m in spec.fingerprint_amounts},
    }
    summary = rollup.select(*[expr.alias(name) for name, expr in fields.items()])
    payload = F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false"})
    return summary.withColumn("fingerprint_sha256", F.sha2(payload, 256))


def header_row(df: DataFrame) -> Column:
    """Whether a row is a header read as data: texts are their column's name, numbers no number."""
    same = F.lit(True)
    for name, kind in df.dtypes:
        same = same & (F.col(name).eqNullSafe(name) if kind == "string" else F.col(name).isNull())
    return same


def aggregate_pre_checks(
    candidate: DataFrame,
    period: str,
    columns: list[str] | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Errors of a delivery that should hold exactly one requested period, in one row.

    ``columns`` are those of the history, in order, when the delivery is to be
    appended.  A missing column ends the check, as nothing else can be said.
    """
    required = dict.fromkeys((*spec.keys, *spec.fingerprint_counts, *spec.fingerprint_amounts))
    missing = [c for c in required if c not in candidate.columns]
    if missing:
        message = MESSAGES["missing_columns"] + ", ".join(missing)
        return candidate.sparkSession.range(1).select(
            F.lit(period).alias(spec.period),
            F.lit(None).cast("bigint").alias("row_count"),
            F.lit(message).alias("errors"),
        )
    found = (
        candidate.groupBy(F.col(spec.period).alias("p"))
        .agg(F.count("*").alias("n"), F.count_if(header_row(candidate)).alias("headers"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("headers"), F.lit(0)).alias("headers"),
            F.array_sort(F.collect_set("p")).alias("periods"),
        )
    )
    shown = F.when(F.size("periods") == 0, "<empty>").otherwise(F.array_join("periods", ", "))
    other = ~(F.array_join("periods", ",") == period)
    checks = [
        F.when(F.size("periods") > 1, MESSAGES["multiple_periods"]).when(
            other,
            F.concat(F.lit(MESSAGES["other_period"]), shown),
        ),
        F.when(F.col("headers") > 0, MESSAGES["header_row"]),
        F.when(F.col("row_count") == 0, MESSAGES["no_rows"]),
    ]
    if columns is not None and list(columns) != candidate.columns:
        checks.append(F.lit(MESSAGES["other_columns"]))
    return found.select(
        F.lit(period).alias(spec.period),
        "row_count",
        F.array_join(F.array_compact(F.array(*checks)), ";").alias("errors"),
    )


def compare_periods(
    candidate: DataFrame,
    existing: DataFrame | None,
    requested: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Fingerprints of candidates against those of the history; one row per candidate period.

    ``existing=None`` means that there is no history at all.  ``requested`` (one
    column of periods) adds the periods that were asked for but not delivered,
    which fail.
    """
    new = candidate.select(
        spec.period,
        F.col("row_count").alias("rows_processed"),
        F.col("fingerprint_sha256").alias("period_fingerprint_hash"),
    )
    if requested is not None:
        wanted = requested.select(F.col(requested.columns[0]).alias(spec.period)).distinct()
        new = wanted.join(new, spec.period, "left")
    failed = F.col("rows_processed").isNull()
    if existing is None:
        return new.select(
            "*",
            F.lit(None).cast("bigint").alias("rows_existing"),
            F.lit(None).cast("string").alias("existing_hash"),
            F.when(failed, "failed").otherwise("missing_concentrado").alias("comparison_status"),
        )
    old = existing.select(
        spec.period,
        F.col("row_count").alias("rows_existing"),
        F.col("fingerprint_sha256").alias("existing_hash"),
    )
    status = (
        F.when(failed, "failed")
        .when(F.col("rows_existing").isNull(), "new_period")
        .when(
            F.col("rows_existing") != F.col("rows_processed"),
            "conflict_existing_period_row_count",
        )
        .when(
            F.col("existing_hash") != F.col("period_fingerprint_hash"),
            "conflict_existing_period_hash",
        )
        .otherwise("already_exists")
    )
    return new.join(old, spec.period, "left").withColumn("comparison_status", status)


# Status, action and reason of a publish decision per comparison status.
PUBLISH_DECISIONS = {
    "already_exists": (
        "success",
        "no_op",
        "Period already exists in concentrado and matches functionally.",
    ),
    "new_period": (
        "success",
        "insert_candidate",
        "Period does not exist in concentrado; dry-run only.",
    ),
    "conflict_existing_period_hash": (
        "blocked",
        "block",
        "Existing period fingerprint differs from aggregate fingerprint.",
    ),
    "conflict_existing_period_row_count": (
        "blocked",
        "block",
        "Existing period row count differs from aggregate row count.",
    ),
    "missing_concentrado": (
        "blocked",
        "block",
        "Concentrado file does not exist; dry-run will not create it.",
    ),
    "failed": ("failed", "block", "Comparison failed; publish planning is blocked."),
}


def publish_plan(comparison: DataFrame) -> DataFrame:
    """Status, action and reason per period; an unknown comparison status is treated as failed."""

    def pick(position: int) -> Column:
        pairs = [F.lit(v) for k, d in PUBLISH_DECISIONS.items() for v in (k, d[position])]
        known = F.create_map(*pairs)[F.col("comparison_status")]
        return F.coalesce(known, F.lit(PUBLISH_DECISIONS["failed"][position]))

    return comparison.withColumns(
        {"status": pick(0), "action": pick(1), "reason": pick(2)}
    )


def period_results(
    comparison: DataFrame, audit: DataFrame, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """One result per candidate period: a failed audit first, then the comparison."""
    joined = comparison.join(
        audit.select(
            F.col("periodo").alias(spec.period), F.col("status").alias("audit_status"), "errors"
        ),
        spec.period,
        "left",
    )
    # a row for which nothing was delivered has failed its audit as an empty period
    failed = F.coalesce(F.col("audit_status") != "success", F.lit(True))
    new = F.col("comparison_status").isin("new_period", "missing_concentrado")
    status = (
        F.when(failed, "failed_audit")
        .when(new, "success_loaded")
        .when(F.col("comparison_status") == "failed", "failed_processing")
        .otherwise(F.col("comparison_status"))
    )
    loaded = F.col("status") == "success_loaded"
    return joined.withColumn("status", status).select(
        spec.period,
        "status",
        "rows_processed",
        F.when(loaded, F.lit(0)).otherwise(F.col("rows_existing")).alias("rows_existing"),
        F.when(loaded, F.col("rows_processed")).otherwise(0).alias("rows_loaded"),
        "period_fingerprint_hash",
        "audit_status",
        F.when(failed, F.col("errors")).alias("error"),
    )


def run_status(results: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """The whole run in one row: status, period lists and row totals (one input row per month)."""
    status = F.col("status")
    loaded = F.count_if(status == "success_loaded")
    unchanged = F.count_if(status == "already_exists")
    warnings = F.count_if(~status.isin("success_loaded", "already_exists"))

    def periods(condition: Column) -> Column:
        listed = F.array_sort(F.collect_list(F.when(condition, F.col(spec.period))))
        return F.array_join(listed, ",")

    run = (
        F.when((loaded == 0) & (unchanged > 0) & (warnings == 0), "success_no_changes")
        .when((loaded + unchanged > 0) & (warnings > 0), "completed_with_warnings")
        .when(loaded + unchanged > 0, "success")
        .otherwise("failed")
    )
    processed = F.coalesce("rows_processed", F.lit(0))
    return results.agg(
        run.alias("status"),
        periods(status == "success_loaded").alias("periods_loaded"),
        periods(status == "already_exists").alias("periods_existing"),
        periods(status.startswith("conflict_existing_period")).alias("periods_conflict"),
        periods(status.startswith("failed_")).alias("periods_failed"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum(processed - F.col("rows_loaded")), F.lit(0)).alias("rows_not_loaded"),
    )


def publish_post_checks(
    before: DataFrame,
    inserted: DataFrame,
    after: DataFrame,
    comparison_after: DataFrame,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Checks of every published period after the append.

    ``before`` and ``after`` hold (period, filas) of the history, ``inserted``
    (period, expected, inserted) and ``comparison_after`` a fresh comparison.
    """
    joined = (
        inserted.join(
            before.select(spec.period, F.col("filas").alias("before")), spec.period, "left"
        )
        .join(after.select(spec.period, F.col("filas").alias("after")), spec.period, "left")
        .join(comparison_after.select(spec.period, "comparison_status"), spec.period, "left")
        .fillna(0, ["before", "after"])
    )

    def fails(condition: Column, message: str) -> Column:
        return F.when(~F.coalesce(condition, F.lit(False)), F.lit(message))

    errors = F.array_compact(
        F.array(
            fails(
                F.col("comparison_status") == "already_exists",
                MESSAGES["not_found_after"],
            ),
            fails(
                F.col("inserted") == F.col("expected"),
                MESSAGES["other_row_count"],
            ),
            fails(
                F.col("before") + F.col("inserted") == F.col("after"),
                MESSAGES["other_total"],
            ),
            fails(
                F.col("after") == F.col("expected"),
                MESSAGES["other_period_count"],
            ),
        )
    )
    passed = F.size(errors) == 0
    return joined.select(
        spec.period,
        F.col("before").alias("rows_before"),
        F.col("inserted").alias("rows_inserted"),
        F.col("after").alias("rows_after"),
        F.when(passed, "success").otherwise("failed_validation").alias("status"),
        F.when(passed, "passed").otherwise("failed").alias("validation_status"),
        F.array_join(errors, "; ").alias("error_message"),
    )


def dedup_ignore_metadata(
    *sources: DataFrame, metadata: tuple[str, ...] = ("timestamp",)
) -> DataFrame:
    """All sources without rows that differ in run metadata only; the first source wins.

    A group is all copies of one row, and one copy may be very frequent, so the
    winner is a MIN combined before the shuffle and not a sorted window.
    """
    columns = sources[0].columns
    kept = [c for c in metadata if c in columns]
    union = None
    for rank, source in enumerate(sources):
        part = source.select(*columns, F.lit(rank).alias("_source"))
        union = part if union is None else union.unionByName(part)
    keys = [c for c in columns if c not in kept]
    first = F.min(F.struct("_source", *kept)).alias("_first")
    return (
        union.groupBy(*keys)
        .agg(first)
        .select(*[F.col(f"_first.{c}").alias(c) if c in kept else F.col(c) for c in columns])
    )


def multiset_differences(
    left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct rows of which one side has more: the ``side`` and how many ``copies`` more.

    Both directions come from one aggregate of signed counts, combined before the shuffle, so
    copies of a row never gather.
    """
    columns = [c for c in left.columns if c not in ignore]
    more = left.select(*columns, F.lit(1).cast("bigint").alias("_signed"))
    less = right.select(*columns, F.lit(-1).cast("bigint").alias("_signed"))
    counted = more.unionByName(less).groupBy(*columns).agg(F.sum("_signed").alias("_signed"))
    return counted.where("_signed <> 0").select(
        F.when(F.col("_signed") > 0, "left").otherwise("right").alias("side"),
        *columns,
        F.abs("_signed").alias("copies"),
    )


def multiset_surplus(
    left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct rows of ``left`` with how many more of each it has than ``right``, if any."""
    both = multiset_differences(left, right, ignore)
    return both.where("side = 'left'").drop("side").withColumnRenamed("copies", "surplus")


SPAN = 10_000  # copies of a row that one task writes out at a time


def multiset_difference(
    left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks, repeated rows counted, by column name.

    Copies are counted before the shuffle and written out after it, in spans that Spark deals
    out evenly, so the copies of one row never come from one task.
    """
    counted = multiset_surplus(left, right, ignore)
    columns = [c for c in counted.columns if c != "surplus"]
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("surplus") - 1, F.lit(SPAN).cast("bigint"))
    spans = counted.withColumn("_at", F.explode(starts)).hint("rebalance")
    size = F.least(F.lit(SPAN).cast("bigint"), F.col("surplus") - F.col("_at"))
    return spans.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_n")).select(
        *columns
    )


def distinct_keys(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Distinct analytic keys per period, a null part counting as a value."""
    return (
        cube.groupBy(*spec.keys)
        .agg(F.count("*").alias("n"))
        .groupBy(spec.period)
        .agg(F.sum("n").alias("filas"), F.count("*").alias("llaves_distintas"))
    )


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.filter("_rank = 1").drop("_rank")
