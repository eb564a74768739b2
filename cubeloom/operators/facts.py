"""Staging to facts: set-based loads, reconciliation and control updates.

Every function handles all periods at once.  Period-level tables (control,
manifests, checks) have one row per month or run; joins to them carry no hint,
so Spark broadcasts them only while their measured size allows it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeloom.functions.numbers import exact_sum
from cubeloom.functions.text import strip
from cubeloom.operators.history import latest_per_key
from cubeloom.operators.normalize import fact_defaults
from cubeloom.spec import DEFAULT_SPEC, CubeSpec


def _periods(df: DataFrame, spec: CubeSpec) -> DataFrame:
    return df.select(spec.period).distinct()


# ---------------------------------------------------------------- loads


def rows_to_stage(
    staged_form: DataFrame,
    control: DataFrame,
    staged: DataFrame,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Rows of periods that have a control row and are not among the ``staged`` periods.

    The period lists are period-level tables (commit rows, say), so that the wide rows are
    joined without a shuffle of their own.
    """
    return staged_form.join(_periods(control, spec), spec.period, "left_semi").join(
        _periods(staged, spec), spec.period, "left_anti"
    )


def staging_outcome(
    requested: DataFrame,
    source_counts: DataFrame,
    control: DataFrame,
    staging_counts: DataFrame,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Why each requested period is or is not staged; the counts are per-period tables."""
    joined = (
        _periods(requested, spec)
        .join(
            _periods(control, spec).withColumn("period_control_exists", F.lit(True)),
            spec.period,
            "left",
        )
        .join(source_counts.select(spec.period, F.col("filas").alias("matched")), spec.period, "left")
        .join(staging_counts.select(spec.period, F.col("filas").alias("staged")), spec.period, "left")
        .fillna(0, ["matched", "staged"])
        .fillna(False, ["period_control_exists"])
    )
    reason = F.when(~F.col("period_control_exists"), "missing_period_control").when(
        F.col("staged") > 0, "staging_period_already_exists"
    )
    inserted = F.when(reason.isNull(), F.col("matched")).otherwise(0)
    return joined.select(
        spec.period,
        "period_control_exists",
        F.col("staged").alias("staging_row_count_before"),
        inserted.alias("rows_inserted_staging"),
        (F.col("staged") + inserted).alias("staging_row_count_after"),
        (inserted > 0).alias("inserted"),
        reason.alias("reason"),
    )


def rows_to_promote(
    staging: DataFrame, control: DataFrame, present: DataFrame, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """Staged rows with fact defaults, for controlled periods that are not ``present`` yet."""
    eligible = staging.join(_periods(control, spec), spec.period, "left_semi").join(
        _periods(present, spec), spec.period, "left_anti"
    )
    return fact_defaults(eligible.select(*staging.columns), spec)


def promotion_outcome(
    requested: DataFrame,
    control: DataFrame,
    staging_counts: DataFrame,
    fact_counts: DataFrame,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    joined = (
        _periods(requested, spec)
        .join(_periods(control, spec).withColumn("controlled", F.lit(True)), spec.period, "left")
        .join(staging_counts.select(spec.period, F.col("filas").alias("staged")), spec.period, "left")
        .join(fact_counts.select(spec.period, F.col("filas").alias("final")), spec.period, "left")
        .fillna(0, ["staged", "final"])
        .fillna(False, ["controlled"])
    )
    reason = (
        F.when(~F.col("controlled"), "missing_period_control")
        .when(F.col("staged") == 0, "missing_staging_rows")
        .when(F.col("final") > 0, "final_period_already_exists")
    )
    inserted = F.when(reason.isNull(), F.col("staged")).otherwise(0)
    return joined.select(
        spec.period,
        F.col("staged").alias("staging_row_count_before"),
        F.col("final").alias("final_row_count_before"),
        inserted.alias("rows_inserted_final"),
        reason.alias("reason"),
    )


# ---------------------------------------------------------------- reconciliation


# what a stored period says of itself, in this order
SIDE_TOTALS = (
    "filas bigint, sum_ta double, sum_ta_sal double, sum_masa_sal_ta double, "
    "flag_blank bigint, flag_unavailable bigint, flag_zero bigint"
)


def side_totals(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows, sums and flag counts of every period, as ``SIDE_TOTALS`` names them."""
    roles = {"sum_ta": spec.jobs, "sum_ta_sal": spec.jobs_paid, "sum_masa_sal_ta": spec.payroll}
    flag = F.col(spec.flag)
    return df.groupBy(spec.period).agg(
        F.count("*").alias("filas"),
        *[F.coalesce(exact_sum(F.col(c)), F.lit(0.0)).alias(n) for n, c in roles.items()],
        F.count_if(F.coalesce(F.trim(flag), F.lit("")) == "").alias("flag_blank"),
        F.count_if(flag == spec.unavailable).alias("flag_unavailable"),
        F.count_if(flag == "0").alias("flag_zero"),
    )


MATCHES = ("row_count", "sum_ta", "sum_ta_sal", "sum_masa_sal_ta")


def _side(totals: DataFrame, prefix: str, flags: tuple[str, ...], spec: CubeSpec) -> DataFrame:
    names = ("filas", *MATCHES[1:])
    return totals.select(
        spec.period,
        *[F.col(n).alias(f"{prefix}_{m}") for n, m in zip(names, MATCHES)],
        *[F.col(f).alias(f"{prefix}_{f}") for f in flags],
    )


def _with_matches(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"{m}_match": F.col(f"staging_{m}") == F.col(f"final_{m}") for m in MATCHES}
    )


def _failed(checks: dict[str, Column]) -> Column:
    """Names of the checks that do not hold, in order."""
    return F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()]))


def post_promotion_checks(
    staging: DataFrame,
    facts: DataFrame,
    control: DataFrame,
    requested: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Staging against facts for every period: one pass over each table.

    A literal 'unavailable' label in the staged flag makes the blank check fail,
    because the facts count labels and staging counts blanks.
    """
    return checks_of_totals(
        side_totals(staging, spec), side_totals(facts, spec), control, requested, spec
    )


def checks_of_totals(
    staging: DataFrame,
    facts: DataFrame,
    control: DataFrame,
    requested: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """:func:`post_promotion_checks` from what :func:`side_totals` or commit rows say."""
    left = _side(staging, "staging", ("flag_blank",), spec)
    right = _side(facts, "final", ("flag_unavailable", "flag_zero"), spec)
    sides = left.join(right, spec.period, "full_outer")
    known = control.select(spec.period, F.col("status").alias("period_control_status"), F.lit(True).alias("period_control_exists"))
    joined = sides.join(known, spec.period, "left")
    if requested is not None:
        joined = _periods(requested, spec).join(joined, spec.period, "left")
    counts = [
        f"{side}_{m}" for side in ("staging", "final") for m in MATCHES
    ] + ["staging_flag_blank", "final_flag_unavailable", "final_flag_zero"]
    joined = _with_matches(joined.fillna(0, counts).fillna(False, ["period_control_exists"]))
    flag_match = F.col("staging_flag_blank") == F.col("final_flag_unavailable")
    checks = {
        "period_control_exists": F.col("period_control_exists"),
        "staging_row_count_positive": F.col("staging_row_count") > 0,
        "final_row_count_positive": F.col("final_row_count") > 0,
        **{f"{m}_match": F.col(f"{m}_match") for m in MATCHES},
        f"{spec.flag}_empty_to_{spec.unavailable}_match": flag_match,
        f"final_{spec.flag}_zero_rows_zero": (F.col("staging_flag_blank") == 0)
        | (F.col("final_flag_zero") == 0),
    }
    return joined.withColumn("_failed", _failed(checks)).select(
        spec.period,
        "period_control_exists",
        "period_control_status",
        *[f"{side}_{m}" for m in MATCHES for side in ("staging", "final")],
        *[f"{m}_match" for m in MATCHES],
        F.col("staging_flag_blank").alias(f"staging_{spec.flag}_empty_rows"),
        F.col("final_flag_unavailable").alias(f"final_{spec.flag}_{spec.unavailable}_rows"),
        F.col("final_flag_zero").alias(f"final_{spec.flag}_zero_rows"),
        flag_match.alias(f"{spec.flag}_empty_to_{spec.unavailable}_match"),
        F.when(F.size("_failed") == 0, "passed").otherwise("failed").alias("validation_status"),
        F.array_join("_failed", ";").alias("failed_checks"),
    )


# ---------------------------------------------------------------- finalise


def finalize_control(
    control: DataFrame,
    checks: DataFrame,
    loaded_at: Column | None = None,
    run_id: str | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """The control table after the checks: pending and passed periods become loaded.

    Adds ``finalized`` and, where nothing changed, the ``reason``.
    """
    seen = checks.select(
        spec.period,
        "validation_status",
        "final_row_count",
        "final_sum_ta",
        "final_sum_ta_sal",
        "final_sum_masa_sal_ta",
    )
    status = F.col("status")
    passed = F.coalesce(F.col("validation_status") == "passed", F.lit(False))
    done = (status == "pending") & passed
    reason = (
        F.when(~passed, "post_promotion_validation_failed")
        .when(status == "loaded", "period_already_loaded")
        .when(status != "pending", "unsupported_period_control_status")
    )
    updates = {
        "row_count": F.col("final_row_count"),
        "sum_ta": F.col("final_sum_ta"),
        "sum_ta_sal": F.col("final_sum_ta_sal"),
        "sum_masa_sal_ta": F.col("final_sum_masa_sal_ta"),
        "loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(),
        "error_message": F.lit(None).cast("string"),
        "run_id": F.coalesce(F.lit(run_id), F.col("run_id")),
        "status": F.lit("loaded"),
    }
    joined = control.join(seen, spec.period, "left")
    return joined.select(
        *[
            F.when(done, updates[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
            for c in control.columns
        ],
        "validation_status",
        done.alias("finalized"),
        reason.alias("reason"),
    )


def _manifest_field(name: str) -> Column:
    return F.get_json_object("manifest_json", f"$.{name}")


def finalize_manifests(
    manifests: DataFrame,
    checks: DataFrame,
    finished_at: Column | None = None,
    requested: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Pending manifests of loaded, passed periods become completed, with the checks as JSON.

    A manifest belongs to the period of its JSON, or to that of ``requested``
    (run_id, period) when given; a differing period in the JSON is a mismatch.
    """
    own = _manifest_field(spec.period)
    if requested is None:
        target = manifests.withColumn("_period", own)
    else:
        target = manifests.join(
            requested.select("run_id", F.col(spec.period).alias("_period")), "run_id", "left"
        )
    joined = target.join(
        checks.withColumnRenamed(spec.period, "_checked"),
        F.col("_period") == F.col("_checked"),
        "left",
    )
    reason = (
        F.when(~F.coalesce("period_control_exists", F.lit(False)), "missing_period_control")
        .when(F.col("validation_status") != "passed", "post_promotion_validation_failed")
        .when(~F.col("period_control_status").eqNullSafe("loaded"), "period_not_loaded")
        .when(F.col("status") == "completed", "run_manifest_already_completed")
        .when(~F.col("status").eqNullSafe("pending"), "unsupported_run_manifest_status")
        .when(own.isNotNull() & (own != F.col("_period")), "run_manifest_period_mismatch")
    )
    carried = [c for c in checks.columns if c.endswith(("_match", "_rows", "_count"))]
    payload = F.to_json(
        F.struct(
            F.lit("final_manifest").alias("mode"),
            F.col("run_id"),
            F.col("_period").alias(spec.period),
            F.lit("loaded").alias("period_control_status"),
            F.lit("passed").alias("validation_status"),
            F.col("final_row_count").alias("row_count"),
            F.col("final_sum_ta").alias("sum_ta"),
            F.col("final_sum_ta_sal").alias("sum_ta_sal"),
            F.col("final_sum_masa_sal_ta").alias("sum_masa_sal_ta"),
            *carried,
            F.col("manifest_json").alias("previous_manifest_json"),
        )
    )
    done = F.col("_reason").isNull()
    finished = finished_at if finished_at is not None else F.current_timestamp()
    updates = {
        "run_mode": F.lit("final_manifest"),
        "status": F.lit("completed"),
        "started_at": F.coalesce("started_at", "created_at"),
        "finished_at": finished,
        "manifest_json": payload,
    }
    return joined.withColumn("_reason", reason).select(
        *[
            F.when(done, updates[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
            for c in manifests.columns
        ],
        done.alias("finalized"),
        F.col("_reason").alias("reason"),
    )


# ---------------------------------------------------------------- existing periods


def existing_period_check(
    requested: DataFrame, control: DataFrame, fact_counts: DataFrame, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """Whether each requested period is known to control or already has facts."""
    joined = (
        _periods(requested, spec)
        .join(
            control.select(
                spec.period,
                F.col("status").alias("period_control_status"),
                F.col("row_count").alias("period_control_row_count"),
                F.lit(True).alias("period_control_exists"),
            ),
            spec.period,
            "left",
        )
        .join(
            fact_counts.select(spec.period, F.col("filas").alias("final_table_row_count")),
            spec.period,
            "left",
        )
        .fillna(0, ["final_table_row_count"])
        .fillna(False, ["period_control_exists"])
    )
    has_rows = F.col("final_table_row_count") > 0
    return joined.select(
        spec.period,
        "period_control_exists",
        "period_control_status",
        "period_control_row_count",
        "final_table_row_count",
        (F.col("period_control_exists") | has_rows).alias("exists"),
        F.when(F.col("period_control_exists"), "already_exists")
        .when(has_rows, "conflict_existing_final_rows_without_control")
        .otherwise("new_period")
        .alias("recommended_status"),
    )


def register_pending(
    existing: DataFrame,
    run_id: str | None = None,
    source_url: Column | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """New pending control rows for periods :func:`existing_period_check` found new."""
    nothing = F.lit(None)
    return existing.filter(~F.col("exists")).select(
        spec.period,
        F.lit("pending").alias("status"),
        nothing.cast("bigint").alias("row_count"),
        nothing.cast("string").alias("period_fingerprint_hash"),
        *[
            nothing.cast("double").alias(f"sum_{c}")
            for c in (spec.insured, spec.non_workers, spec.jobs, spec.jobs_paid, spec.payroll)
        ],
        F.lit(run_id).cast("string").alias("run_id"),
        (source_url if source_url is not None else nothing.cast("string")).alias("source_url"),
        nothing.cast("timestamp").alias("loaded_at"),
        nothing.cast("string").alias("error_message"),
    )


def register_manifests(
    wanted: DataFrame, control: DataFrame, manifests: DataFrame, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """New pending manifests for (run_id, period) pairs with control and an unused run id."""
    fresh = wanted.join(_periods(control, spec), spec.period, "left_semi").join(
        manifests.select("run_id"), "run_id", "left_anti"
    )
    return fresh.select(
        "run_id",
        F.lit("manifest_only").alias("run_mode"),
        F.lit("pending").alias("status"),
        F.to_json(
            F.struct(
                F.lit("manifest_only").alias("mode"),
                F.col(spec.period),
                F.lit(False).alias("reads_source_csv"),
                F.col("run_id"),
                F.lit(False).alias("touches_final_table"),
                F.lit(False).alias("touches_staging_table"),
            )
        ).alias("manifest_json"),
    )


def latest_completed_manifest(
    manifests: DataFrame, completed: Column, period: Column, created_at: Column, tie: Column
) -> DataFrame:
    """The latest completed manifest of every period, or else simply the latest one."""
    keyed = manifests.withColumns({"_period": period, "_completed": F.coalesce(completed, F.lit(False))})
    order = [F.col("_completed").desc(), created_at.desc_nulls_last(), tie.desc()]
    latest = latest_per_key(keyed.filter(F.col("_period").isNotNull()), "_period", order)
    return latest.withColumn("final_manifest_exists", F.col("_completed")).drop("_completed")


def final_manifests(manifests: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """:func:`latest_completed_manifest` over the manifest table's JSON."""
    completed = (
        (F.col("status") == "completed")
        & (F.col("run_mode") == "final_manifest")
        & (_manifest_field("validation_status") == "passed")
        & (_manifest_field("period_control_status") == "loaded")
    )
    latest = latest_completed_manifest(
        manifests, completed, _manifest_field(spec.period), F.col("created_at"), F.col("run_id")
    )
    return latest.select(
        F.col("_period").alias(spec.period),
        "final_manifest_exists",
        F.col("status").alias("final_manifest_status"),
        F.col("run_mode").alias("final_manifest_run_mode"),
        _manifest_field("validation_status").alias("final_manifest_validation_status"),
        _manifest_field("period_control_status").alias("final_manifest_period_control_status"),
    )


def housekeeping_eligibility(
    source: DataFrame,
    staging: DataFrame,
    facts: DataFrame,
    control: DataFrame,
    manifests: DataFrame,
    requested: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Nine checks per source period; all must hold before the source may be archived."""
    return housekeeping_of_totals(
        source, side_totals(staging, spec), side_totals(facts, spec), control, manifests, requested, spec
    )


def housekeeping_of_totals(
    source: DataFrame,
    staging: DataFrame,
    facts: DataFrame,
    control: DataFrame,
    manifests: DataFrame,
    requested: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """:func:`housekeeping_eligibility` from what :func:`side_totals` or commit rows say."""
    period = F.nullif(strip(F.col(spec.period)), F.lit(""))
    seen = (
        source.groupBy(period.alias(spec.period))
        .agg(F.count("*").alias("csv_rows_detected"))
        .filter(F.col(spec.period).isNotNull())
    )
    evaluated = _periods(requested, spec).join(seen, spec.period, "left") if requested is not None else seen
    sides = [
        _side(staging, "staging", (), spec),
        _side(facts, "final", (), spec),
        control.select(spec.period, F.col("status").alias("period_control_status")),
        manifests,
    ]
    joined = reduce(lambda a, b: a.join(b, spec.period, "left"), sides, evaluated)
    numbers = ["csv_rows_detected"] + [f"{s}_{m}" for s in ("staging", "final") for m in MATCHES]
    joined = _with_matches(joined.fillna(0, numbers).fillna(False, ["final_manifest_exists"]))
    checks = {
        "csv_period_present": F.col("csv_rows_detected") > 0,
        "staging_exists": F.col("staging_row_count") > 0,
        "final_exists": F.col("final_row_count") > 0,
        **{f"{m}_match": F.col(f"{m}_match") for m in MATCHES},
        "period_control_loaded": F.col("period_control_status").eqNullSafe("loaded"),
        "final_manifest_exists": F.col("final_manifest_exists"),
    }
    return joined.withColumn("_failed", _failed(checks)).select(
        spec.period,
        "csv_rows_detected",
        "staging_row_count",
        "final_row_count",
        *[f"{m}_match" for m in MATCHES],
        "period_control_status",
        "final_manifest_exists",
        "final_manifest_status",
        (F.size("_failed") == 0).alias("eligible_for_housekeeping"),
        F.array_join("_failed", ";").alias("failed_checks"),
    )
