"""Back-fill decisions over a month-end calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubeloom.spec import DEFAULT_SPEC, CubeSpec

# The actions, in the order of the histogram.
ACTIONS = (
    "skip_existing",
    "download_process_load",
    "validate_process_load",
    "blocked_existing_pending",
    "blocked_existing_non_loaded",
    "blocked_partial_final",
    "blocked_inconsistent_state",
)
ELIGIBLE = ("download_process_load", "validate_process_load")
SELECTED = 3


def _month_end(period: str, name: str) -> dt.date:
    day = dt.date.fromisoformat(period)
    if (day + dt.timedelta(days=1)).day != 1:
        raise ValueError(f"{name} must be a calendar month-end date")
    return day


def month_ends_between(bounds: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Inclusive month-end periods of every (start, end) row of dates."""
    months = F.sequence(
        F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")
    )
    return bounds.select(F.explode(months).alias("m")).select(
        F.last_day("m").cast("string").alias(spec.period)
    )


def month_end_calendar(
    spark: SparkSession, start: str, end: str, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """Month ends between two explicit month ends; other bounds are an error."""
    first, last = _month_end(start, "start"), _month_end(end, "end")
    if first > last:
        raise ValueError("start must not be after end")
    bounds = spark.range(1).select(F.lit(first).alias("start"), F.lit(last).alias("end"))
    return month_ends_between(bounds, spec)


def batch_plan(
    calendar: DataFrame,
    files: DataFrame,
    existing: DataFrame,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Action, block flag and reason of every calendar period; the first matching rule wins.

    ``files`` lists periods with a raw file, ``existing`` is the output of
    ``existing_period_check`` (periods it lacks count as unknown and empty).
    """
    joined = (
        calendar.join(
            files.select(spec.period).distinct().withColumn("raw_exists", F.lit(True)),
            spec.period,
            "left",
        )
        .join(
            existing.select(
                spec.period,
                "period_control_exists",
                "period_control_status",
                "final_table_row_count",
            ),
            spec.period,
            "left",
        )
        .fillna(False, ["raw_exists", "period_control_exists"])
        .fillna(0, ["final_table_row_count"])
    )
    control = F.col("period_control_exists")
    status = F.coalesce("period_control_status", F.lit(""))
    final = F.col("final_table_row_count") > 0
    rules = [
        (control & (status == "loaded") & final, "skip_existing", "period_loaded_in_postgresql"),
        (
            control & (status == "loaded"),
            "blocked_inconsistent_state",
            "period_control_loaded_without_final_rows",
        ),
        (control & (status == "pending"), "blocked_existing_pending", "period_control_pending"),
        (
            control & (status != ""),
            "blocked_existing_non_loaded",
            "period_control_status_is_not_loaded",
        ),
        (final, "blocked_partial_final", "final_rows_exist_without_loaded_period_control"),
        (control, "blocked_inconsistent_state", "period_control_exists_without_status"),
        (F.col("raw_exists"), "validate_process_load", "raw_exists_and_period_not_loaded"),
        (F.lit(True), "download_process_load", "raw_missing_and_period_not_loaded"),
    ]
    action, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, name, why in reversed(rules):
        action = F.when(condition, F.lit(name)).otherwise(action)
        reason = F.when(condition, F.lit(why)).otherwise(reason)
    return joined.withColumns({"recommended_action": action, "reason": reason}).withColumn(
        "blocked", F.col("recommended_action").startswith("blocked_")
    )


def batch_select(
    plan: DataFrame, max_periods: int = SELECTED, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """Eligible periods in order, the first ``max_periods`` marked as selected.

    The window has no partition: a plan has one row per calendar month.
    """
    if max_periods < 1:
        raise ValueError("max_periods must be at least 1")
    eligible = plan.filter(F.col("recommended_action").isin(*ELIGIBLE) & ~F.col("blocked"))
    place = F.row_number().over(Window.orderBy(spec.period))
    return eligible.select(
        spec.period,
        "recommended_action",
        place.alias("position"),
        (place <= max_periods).alias("selected"),
    )


def batch_action_counts(plan: DataFrame) -> DataFrame:
    """Periods per action, actions without a period as 0."""
    counts = plan.agg(
        *[F.count_if(F.col("recommended_action") == a).alias(a) for a in ACTIONS]
    )
    cells = [
        F.struct(F.lit(a).alias("recommended_action"), F.col(a).alias("periods")) for a in ACTIONS
    ]
    return counts.select(F.inline(F.array(*cells)))
