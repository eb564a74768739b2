"""Staging, facts, control and back-fill queries.

The control table has one row per month of the data, with a status by month
number; facts are the staged cube with faults in some months.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeloom.operators import backfill as B
from cubeloom.operators import facts as L
from cubeloom.operators import normalize as N
from cubeloom.operators.cube import cube_aggregate
from cubeloom.plans import marts
from cubeloom.session import fresh_path, materialize, shuffles_freed
from cubeloom.sources.tables import FactTables
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload.cube_queries import P
from cubeloom.workload.oracle import big, dbl, listed, over
from cubeloom.workload.registry import query
from cubeloom.workload.star_cube import placed_cube, star_cube

MONTH = f"CAST(substring({P}, 6, 2) AS INT)"
STAMP = "TIMESTAMP '2001-12-01 00:00:00'"


def _cube(spark, sf):
    return cube_aggregate(star_cube(spark, sf))


# ---------------------------------------------------------------- projections

_STAGED_TEXT = (
    f"SELECT 'run-1' AS run_id, {listed(SPEC.keys, 'nullif(trim({0}), $$$$) AS {0}')}, "
    f"{listed(SPEC.sums, 'CAST({0} AS DOUBLE) AS {0}')}, "
    + ", ".join(
        f"CAST({' + '.join(n)} AS DOUBLE) / NULLIF(CAST({' + '.join(d)} AS DOUBLE), 0) AS {r}"
        for r, (n, d) in SPEC.ratios.items()
        if r in SPEC.fact_ratios
    )
    + ", CAST(NULL AS VARCHAR) AS period_fingerprint_hash, 'star' AS source_url, "
    "CAST(NULL AS VARCHAR) AS loaded_at, CAST(NULL AS VARCHAR) AS created_at FROM cube"
)


@query("staging_projection", over("cube", _STAGED_TEXT))
def staging_projection(spark, sf):
    """A delivery with padded text, thousands separators and a misspelt column name."""
    cube = _cube(spark, sf)
    delivery = cube.select(
        F.col(P),
        *[
            F.concat(F.lit(" "), F.col(k), F.lit(" ")).alias("tamaÃ±o_patron" if k == "tamaño_patron" else k)
            for k in SPEC.key_dims
        ],
        *[
            F.format_number(c, 4).alias(c) if c.startswith("masa") else F.col(c)
            for c in SPEC.sums
        ],
        *SPEC.fact_ratios,
        F.lit(" star ").alias("source_url"),
    )
    return N.staging_projection(delivery, "run-1")


@query(
    "fact_defaults",
    over(
        "facts",
        f"SELECT {listed(SPEC.keys)}, {listed(SPEC.sums, 'CAST({0} AS DOUBLE) AS {0}')} FROM facts",
    ),
)
def fact_defaults(spark, sf):
    return N.fact_defaults(_cube(spark, sf).select(*SPEC.keys, *SPEC.sums))


# ---------------------------------------------------------------- scenario

# control: no row in March, else by month number
CONTROL_SQL = f"""SELECT {P}, CASE {MONTH} % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'loaded'
WHEN 2 THEN 'failed_load' ELSE 'pending' END AS status, CAST(10 * {MONTH} AS BIGINT) AS row_count
FROM (SELECT DISTINCT {P} FROM norm) WHERE {MONTH} <> 3"""


def _months(spark, sf):
    return star_cube(spark, sf, (P,)).distinct()


def _control(months):
    month = F.expr(MONTH)
    status = (
        F.when(month % 4 == 0, "pending")
        .when(month % 4 == 1, "loaded")
        .when(month % 4 == 2, "failed_load")
        .otherwise("pending")
    )
    null = F.lit(None)
    return months.filter(month != 3).select(
        P,
        status.alias("status"),
        (month * 10).cast("bigint").alias("row_count"),
        null.cast("string").alias("period_fingerprint_hash"),
        *[null.cast("double").alias(f"sum_{c}") for c in ("asegurados", "no_trabajadores", "ta", "ta_sal", "masa_sal_ta")],
        F.lit("run-0").alias("run_id"),
        null.cast("string").alias("source_url"),
        null.cast("timestamp").alias("loaded_at"),
        F.when(month % 4 == 2, "load broke").alias("error_message"),
    )


_FACT_MEASURES = ("ta", "ta_sal", "masa_sal_ta")
# facts: April lacks 49-job rows, May has one job more per row in 1997,
# June has flags '0' instead of the missing ones, July was not promoted
FACT_FAULTS_SQL = f"""SELECT * REPLACE (
CASE WHEN {MONTH} = 5 AND {P} LIKE '1997%' THEN ta + 1 ELSE ta END AS ta,
CASE WHEN {MONTH} = 6 AND ptpd = 'no_disponible' THEN '0' ELSE ptpd END AS ptpd)
FROM facts WHERE NOT ({MONTH} = 4 AND ta > 49) AND {MONTH} <> 7"""


def _staging(spark, sf):
    return _cube(spark, sf).select(*SPEC.keys, *_FACT_MEASURES)


def _facts(staging):
    month = F.expr(MONTH)
    facts = N.fact_defaults(staging)
    extra = (month == 5) & F.col(P).startswith("1997")
    unflagged = (month == 6) & (F.col("ptpd") == SPEC.unavailable)
    return facts.filter(~((month == 4) & (F.col("ta") > 49)) & (month != 7)).withColumns(
        {
            "ta": F.when(extra, F.col("ta") + 1).otherwise(F.col("ta")),
            "ptpd": F.when(unflagged, "0").otherwise(F.col("ptpd")),
        }
    )


_SCENE = {"control": CONTROL_SQL, "final": FACT_FAULTS_SQL}


# ---------------------------------------------------------------- loads


@query(
    "stage_insert_only",
    over(
        "cube",
        f"""SELECT {listed(SPEC.keys)}, {listed(_FACT_MEASURES, "CAST({0} AS DOUBLE) AS {0}")}
        FROM cube WHERE {P} IN (SELECT {P} FROM control) AND {P} >= '1997'""",
        control=CONTROL_SQL,
    ),
)
def stage_insert_only(spark, sf):
    """Staging holds everything before 1997; controlled later months are added."""
    rows = _staging(spark, sf)
    staged = star_cube(spark, sf, (P,)).filter(F.col(P) < "1997")
    return L.rows_to_stage(rows, _control(_months(spark, sf)), staged)


_STAGE_COUNTS = {
    "c": f"SELECT {P}, count(*) AS n FROM raw GROUP BY 1",
    "control": f"SELECT {P} FROM c WHERE {MONTH} <> 3",
}


@query(
    "stage_outcome",
    over(
        "raw",
        f"""SELECT {P}, {MONTH} <> 3 AS period_control_exists,
        {big(f"CASE WHEN {P} < '1997' THEN n ELSE 0 END", "staging_row_count_before")},
        {big(f"CASE WHEN {P} >= '1997' AND {MONTH} <> 3 THEN n ELSE 0 END", "rows_inserted_staging")},
        {big(f"CASE WHEN {P} >= '1997' AND {MONTH} = 3 THEN 0 ELSE n END", "staging_row_count_after")},
        {P} >= '1997' AND {MONTH} <> 3 AS inserted,
        CASE WHEN {MONTH} = 3 THEN 'missing_period_control'
             WHEN {P} < '1997' THEN 'staging_period_already_exists' END AS reason FROM c""",
        **_STAGE_COUNTS,
    ),
)
def stage_outcome(spark, sf):
    counts = star_cube(spark, sf, (P,)).groupBy(P).agg(F.count("*").alias("filas"))
    return L.staging_outcome(
        counts, counts, _control(counts.select(P)), counts.filter(F.col(P) < "1997")
    )


@query(
    "promote_to_facts",
    over(
        "facts",
        f"""SELECT {listed(SPEC.keys)}, {listed(_FACT_MEASURES, "CAST({0} AS DOUBLE) AS {0}")}
        FROM facts WHERE {P} IN (SELECT {P} FROM control) AND {P} >= '1998'""",
        control=CONTROL_SQL,
    ),
)
def promote_to_facts(spark, sf):
    """Facts hold everything before 1998; controlled later months are promoted."""
    present = star_cube(spark, sf, (P,)).filter(F.col(P) < "1998")
    return L.rows_to_promote(_staging(spark, sf), _control(_months(spark, sf)), present)


@query(
    "promotion_outcome",
    over(
        "raw",
        f"""SELECT {P}, {big(f"CASE WHEN {P} < '2001' THEN n ELSE 0 END", "staging_row_count_before")},
        {big(f"CASE WHEN {P} < '1998' THEN n ELSE 0 END", "final_row_count_before")},
        {big(f"CASE WHEN {MONTH} <> 3 AND {P} >= '1998' AND {P} < '2001' THEN n ELSE 0 END",
             "rows_inserted_final")},
        CASE WHEN {MONTH} = 3 THEN 'missing_period_control'
             WHEN {P} >= '2001' THEN 'missing_staging_rows'
             WHEN {P} < '1998' THEN 'final_period_already_exists' END AS reason FROM c""",
        **_STAGE_COUNTS,
    ),
)
def promotion_outcome(spark, sf):
    counts = star_cube(spark, sf, (P,)).groupBy(P).agg(F.count("*").alias("filas"))
    return L.promotion_outcome(
        counts,
        _control(counts.select(P)),
        counts.filter(F.col(P) < "2001"),
        counts.filter(F.col(P) < "1998"),
    )


# ---------------------------------------------------------------- reconciliation

_SUMS = ("row_count", "sum_ta", "sum_ta_sal", "sum_masa_sal_ta")


def _side_sql(table: str) -> str:
    return f"""SELECT {P}, count(*) AS row_count, SUM(ta) AS sum_ta, SUM(ta_sal) AS sum_ta_sal,
    SUM(masa_sal_ta) AS sum_masa_sal_ta,
    count(*) FILTER (WHERE ptpd IS NULL OR trim(ptpd) = '') AS blank,
    count(*) FILTER (WHERE ptpd = 'no_disponible') AS unavailable,
    count(*) FILTER (WHERE ptpd = '0') AS zero FROM {table} GROUP BY 1"""


_CHECKS = {
    "period_control_exists": "known",
    "staging_row_count_positive": "staging_row_count > 0",
    "final_row_count_positive": "final_row_count > 0",
    **{f"{m}_match": f"staging_{m} = final_{m}" for m in _SUMS},
    "ptpd_empty_to_no_disponible_match": "blank = unavailable",
    "final_ptpd_zero_rows_zero": "blank = 0 OR zero = 0",
}
_FAILED = (
    "concat_ws(';', "
    + ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _CHECKS.items())
    + ")"
)
_RECONCILED = {
    **_SCENE,
    "st": _side_sql("cube"),
    "fi": _side_sql("final"),
    "both_sides": f"SELECT s.{P}, c.{P} IS NOT NULL AS known, c.status, "
    + ", ".join(
        f"coalesce({t}.{m}, 0) AS {name}_{m}" for t, name in (("s", "staging"), ("f", "final")) for m in _SUMS
    )
    + ", s.blank, coalesce(f.unavailable, 0) AS unavailable, coalesce(f.zero, 0) AS zero "
    f"FROM st s LEFT JOIN fi f ON s.{P} = f.{P} LEFT JOIN control c ON s.{P} = c.{P}",
    "checks": f"SELECT *, {_FAILED} AS failed FROM both_sides",
}


@query(
    "post_promotion_checks",
    over(
        "facts",
        f"SELECT {P}, known AS period_control_exists, status AS period_control_status, "
        + ", ".join(
            (big if m == "row_count" else dbl)(f"{side}_{m}", f"{side}_{m}")
            for side in ("staging", "final")
            for m in _SUMS
        )
        + ", "
        + ", ".join(f"staging_{m} = final_{m} AS {m}_match" for m in _SUMS)
        + f""", {big("blank", "staging_ptpd_empty_rows")},
        {big("unavailable", "final_ptpd_no_disponible_rows")},
        {big("zero", "final_ptpd_zero_rows")},
        blank = unavailable AS ptpd_empty_to_no_disponible_match,
        CASE WHEN failed = '' THEN 'passed' ELSE 'failed' END AS validation_status,
        failed AS failed_checks FROM checks""",
        **_RECONCILED,
    ),
)
def post_promotion_checks(spark, sf):
    staging = _staging(spark, sf)
    return L.post_promotion_checks(staging, _facts(staging), _control(_months(spark, sf)))


@query(
    "finalize_control",
    over(
        "facts",
        f"""SELECT {P}, CASE WHEN done THEN 'loaded' ELSE status END AS status,
        {big("CASE WHEN done THEN final_row_count ELSE row_count END", "row_count")},
        {", ".join(dbl(f"CASE WHEN done THEN final_{m} END", m) for m in _SUMS[1:])},
        CASE WHEN done THEN 'run-9' ELSE 'run-0' END AS run_id,
        CASE WHEN done THEN {STAMP} END AS loaded_at,
        CASE WHEN status = 'failed_load' AND NOT done THEN 'load broke' END AS error_message,
        CASE WHEN failed = '' THEN 'passed' ELSE 'failed' END AS validation_status,
        done AS finalized,
        CASE WHEN failed <> '' THEN 'post_promotion_validation_failed'
             WHEN status = 'loaded' THEN 'period_already_loaded'
             WHEN status <> 'pending' THEN 'unsupported_period_control_status' END AS reason
        FROM f""",
        **_RECONCILED,
        f=f"""SELECT k.*, c.row_count, k.status = 'pending' AND failed = '' AS done
        FROM checks k JOIN control c ON k.{P} = c.{P}""",
    ),
)
def finalize_control(spark, sf):
    staging = _staging(spark, sf)
    control = _control(_months(spark, sf))
    checks = L.post_promotion_checks(staging, _facts(staging), control)
    stamp = F.expr("TIMESTAMP_NTZ '2001-12-01 00:00:00'").cast("timestamp")
    done = L.finalize_control(control, checks, loaded_at=stamp, run_id="run-9")
    return done.drop(
        "period_fingerprint_hash", "source_url", "sum_asegurados", "sum_no_trabajadores"
    ).withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


# one manifest per month, by month number: completed, for a wrong month, failed, else pending
_MANIFESTS_SQL = f"""SELECT 'run-' || {P} AS run_id, CASE WHEN {MONTH} = 1 THEN 'completed'
WHEN {MONTH} = 2 THEN 'failed' ELSE 'pending' END AS status,
CASE WHEN {MONTH} = 9 THEN '1900-01-31' ELSE {P} END AS own, {P} AS p FROM st"""


def _manifests(months):
    month = F.expr(MONTH)
    own = F.when(month == 9, "1900-01-31").otherwise(F.col(P))
    return months.select(
        F.concat(F.lit("run-"), P).alias("run_id"),
        F.lit("manifest_only").alias("run_mode"),
        F.lit(None).cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.when(month == 1, "completed").when(month == 2, "failed").otherwise("pending").alias("status"),
        F.to_json(F.struct(own.alias(P))).alias("manifest_json"),
        F.expr(STAMP).alias("created_at"),
    )


@query(
    "finalize_manifests",
    over(
        "facts",
        """SELECT run_id, CASE WHEN reason IS NULL THEN 'completed' ELSE status END AS status,
        CASE WHEN reason IS NULL THEN 'final_manifest' ELSE 'manifest_only' END AS run_mode,
        reason IS NULL AS finalized, reason,
        CASE WHEN reason IS NULL THEN 'passed' END AS validation_status,
        CASE WHEN reason IS NULL THEN CAST(final_row_count AS VARCHAR) END AS row_count
        FROM (SELECT *, CASE WHEN NOT known THEN 'missing_period_control'
          WHEN failed <> '' THEN 'post_promotion_validation_failed'
          WHEN control_status <> 'loaded' THEN 'period_not_loaded'
          WHEN status = 'completed' THEN 'run_manifest_already_completed'
          WHEN status <> 'pending' THEN 'unsupported_run_manifest_status'
          WHEN own <> p THEN 'run_manifest_period_mismatch' END AS reason FROM f)""",
        **_RECONCILED,
        m=_MANIFESTS_SQL,
        f=f"""SELECT m.*, k.known, k.failed, k.status AS control_status, k.final_row_count
        FROM m JOIN checks k ON m.p = k.{P}""",
    ),
)
def finalize_manifests(spark, sf):
    staging = _staging(spark, sf)
    months = _months(spark, sf)
    checks = L.post_promotion_checks(staging, _facts(staging), _control(months))
    manifests = _manifests(months)
    requested = months.select(F.concat(F.lit("run-"), P).alias("run_id"), P)
    done = L.finalize_manifests(manifests, checks, requested=requested)
    return done.select(
        "run_id",
        "status",
        "run_mode",
        "finalized",
        "reason",
        F.get_json_object("manifest_json", "$.validation_status").alias("validation_status"),
        F.get_json_object("manifest_json", "$.row_count").alias("row_count"),
    )


@query(
    "housekeeping_eligibility",
    over(
        "facts",
        f"""SELECT {P}, {big("r", "csv_rows_detected")}, {big("staging_row_count", "staging_row_count")},
        {big("final_row_count", "final_row_count")},
        {", ".join(f"staging_{m} = final_{m} AS {m}_match" for m in _SUMS)},
        status AS period_control_status, done AS final_manifest_exists,
        CASE WHEN done THEN 'completed' ELSE 'pending' END AS final_manifest_status,
        failed = '' AS eligible_for_housekeeping, failed AS failed_checks
        FROM (SELECT *, concat_ws(';',
          CASE WHEN final_row_count = 0 THEN 'final_exists' END,
          {", ".join(f"CASE WHEN staging_{m} <> final_{m} THEN '{m}_match' END" for m in _SUMS)},
          CASE WHEN coalesce(status, '') <> 'loaded' THEN 'period_control_loaded' END,
          CASE WHEN NOT done THEN 'final_manifest_exists' END) AS failed
          FROM (SELECT b.*, r, ({MONTH} <> 5) AS done FROM both_sides b
                JOIN (SELECT {P}, count(*) AS r FROM raw GROUP BY 1) USING ({P})))""",
        **{k: v for k, v in _RECONCILED.items() if k != "checks"},
    ),
)
def housekeeping_eligibility(spark, sf):
    """Every month has a pending and, but for May, an older completed manifest."""
    staging = _staging(spark, sf)
    months = _months(spark, sf)
    month = F.expr(MONTH)
    pending = _manifests(months).withColumn("status", F.lit("pending")).withColumn(
        "manifest_json", F.to_json(F.struct(F.expr(f"substring(run_id, 5, 10)").alias(P)))
    )
    completed = months.filter(month != 5).select(
        F.concat(F.lit("done-"), P).alias("run_id"),
        F.lit("final_manifest").alias("run_mode"),
        F.lit("completed").alias("status"),
        F.to_json(
            F.struct(
                F.col(P),
                F.lit("passed").alias("validation_status"),
                F.lit("loaded").alias("period_control_status"),
            )
        ).alias("manifest_json"),
        F.expr(f"{STAMP} - interval 1 day").alias("created_at"),
    )
    manifests = L.final_manifests(pending.unionByName(completed, allowMissingColumns=True))
    return L.housekeeping_eligibility(
        star_cube(spark, sf, (P,)), staging, _facts(staging), _control(months), manifests
    )


# ---------------------------------------------------------------- control and back-fill

# facts are counted before 1999 only; control has no row in March and in 2001
_EXISTING = {
    "c": f"SELECT {P}, count(*) AS n FROM raw GROUP BY 1",
    "control": f"""SELECT {P}, CASE {MONTH} % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'loaded'
    WHEN 2 THEN 'failed_load' ELSE 'pending' END AS status,
    CAST(10 * {MONTH} AS BIGINT) AS row_count FROM c WHERE {MONTH} <> 3 AND {P} < '2001'""",
    "ex": f"""SELECT r.{P}, k.{P} IS NOT NULL AS period_control_exists,
    k.status AS period_control_status, k.row_count AS period_control_row_count,
    {big("coalesce(f.n, 0)", "final_table_row_count")},
    k.{P} IS NOT NULL OR coalesce(f.n, 0) > 0 AS exists,
    CASE WHEN k.{P} IS NOT NULL THEN 'already_exists'
         WHEN coalesce(f.n, 0) > 0 THEN 'conflict_existing_final_rows_without_control'
         ELSE 'new_period' END AS recommended_status
    FROM c r LEFT JOIN control k ON r.{P} = k.{P}
    LEFT JOIN (SELECT * FROM c WHERE {P} < '1999') f ON r.{P} = f.{P}""",
}


def _existing(spark, sf):
    counts = star_cube(spark, sf, (P,)).groupBy(P).agg(F.count("*").alias("filas"))
    control = _control(counts.select(P)).filter(F.col(P) < "2001")
    return L.existing_period_check(counts, control, counts.filter(F.col(P) < "1999"))


@query("existing_period_check", over("raw", "SELECT * FROM ex", **_EXISTING))
def existing_period_check(spark, sf):
    return _existing(spark, sf)


@query(
    "register_pending",
    over(
        "raw",
        f"""SELECT {P}, 'pending' AS status, CAST(NULL AS BIGINT) AS row_count, 'run-5' AS run_id,
        'landing/asg-' || {P} || '.csv' AS source_url FROM ex WHERE NOT exists""",
        **_EXISTING,
    ),
)
def register_pending(spark, sf):
    url = F.concat(F.lit("landing/asg-"), P, F.lit(".csv"))
    rows = L.register_pending(_existing(spark, sf), "run-5", url)
    return rows.select(P, "status", "row_count", "run_id", "source_url")


@query(
    "register_manifests",
    over(
        "raw",
        f"""SELECT 'run-' || {P} AS run_id, 'manifest_only' AS run_mode, 'pending' AS status,
        '{{"mode":"manifest_only","{P}":"' || {P} || '","reads_source_csv":false,"run_id":"run-'
        || {P} || '","touches_final_table":false,"touches_staging_table":false}}' AS manifest_json
        FROM c WHERE {MONTH} <> 3 AND {P} < '2001' AND {MONTH} <> 12""",
        **_EXISTING,
    ),
)
def register_manifests(spark, sf):
    """December runs are registered already, March has no control row."""
    months = _months(spark, sf)
    control = _control(months).filter(F.col(P) < "2001")
    wanted = months.select(F.concat(F.lit("run-"), P).alias("run_id"), P)
    return L.register_manifests(wanted, control, wanted.filter(F.expr(MONTH) == 12))


@query(
    "mart_period_control",
    over(
        "norm",
        f"""SELECT {P}, status, row_count, CAST(NULL AS VARCHAR) AS period_fingerprint_hash,
        CAST(NULL AS DOUBLE) AS sum_asegurados, CAST(NULL AS DOUBLE) AS sum_no_trabajadores,
        CAST(NULL AS DOUBLE) AS sum_ta, CAST(NULL AS DOUBLE) AS sum_ta_sal,
        CAST(NULL AS DOUBLE) AS sum_masa_sal_ta, 'run-0' AS run_id,
        CAST(NULL AS VARCHAR) AS source_url, CAST(NULL AS TIMESTAMP) AS loaded_at,
        CASE WHEN status = 'failed_load' THEN 'load broke' END AS error_message FROM control""",
        control=CONTROL_SQL,
    ),
)
def mart_period_control(spark, sf):
    return marts.mart_period_control(_control(_months(spark, sf))).withColumn(
        "loaded_at", F.col("loaded_at").cast("timestamp_ntz")
    )


_CALENDAR_SQL = f"""SELECT CAST(last_day(CAST(m AS DATE)) AS VARCHAR) AS {P} FROM (
SELECT unnest(generate_series(date_trunc('month', MIN(CAST(l_shipdate AS DATE))) - INTERVAL 3 MONTH,
date_trunc('month', MAX(CAST(l_shipdate AS DATE))) + INTERVAL 4 MONTH, INTERVAL 1 MONTH)) AS m
FROM lineitem)"""


def _calendar(spark, sf):
    """Three months before the data until four months after it."""
    day = F.col(P).cast("date")
    bounds = star_cube(spark, sf, (P,)).agg(
        F.add_months(F.min(day), -3).alias("start"), F.add_months(F.max(day), 4).alias("end")
    )
    return B.month_ends_between(bounds)


@query("month_end_calendar", f"SELECT * FROM ({_CALENDAR_SQL})")
def month_end_calendar(spark, sf):
    return _calendar(spark, sf)


_RULES = (
    ("pe AND st = 'loaded' AND n > 0", "skip_existing", "period_loaded_in_postgresql"),
    ("pe AND st = 'loaded'", "blocked_inconsistent_state", "period_control_loaded_without_final_rows"),
    ("pe AND st = 'pending'", "blocked_existing_pending", "period_control_pending"),
    ("pe AND st IS NOT NULL", "blocked_existing_non_loaded", "period_control_status_is_not_loaded"),
    ("n > 0", "blocked_partial_final", "final_rows_exist_without_loaded_period_control"),
    ("raw_exists", "validate_process_load", "raw_exists_and_period_not_loaded"),
    ("true", "download_process_load", "raw_missing_and_period_not_loaded"),
)
_PLAN = {
    **_EXISTING,
    "cal": _CALENDAR_SQL,
    "plan": f"""SELECT {P}, raw_exists, pe AS period_control_exists, st AS period_control_status,
    n AS final_table_row_count,
    CASE {" ".join(f"WHEN {c} THEN '{a}'" for c, a, _ in _RULES)} END AS recommended_action,
    CASE {" ".join(f"WHEN {c} THEN '{r}'" for c, _, r in _RULES)} END AS reason
    FROM (SELECT cal.{P}, coalesce(ex.{P} >= '1995-06', false) AS raw_exists,
    coalesce(ex.period_control_exists, false) AS pe, ex.period_control_status AS st,
    {big("coalesce(ex.final_table_row_count, 0)", "n")} FROM cal LEFT JOIN ex ON cal.{P} = ex.{P})""",
    "marked": "SELECT *, recommended_action LIKE 'blocked%' AS blocked FROM plan",
}


def _plan(spark, sf):
    files = star_cube(spark, sf, (P,)).filter(F.col(P) >= "1995-06")
    return B.batch_plan(_calendar(spark, sf), files, _existing(spark, sf))


@query("batch_plan", over("raw", "SELECT * FROM marked", **_PLAN))
def batch_plan(spark, sf):
    return _plan(spark, sf)


@query(
    "batch_select",
    over(
        "raw",
        f"""SELECT {P}, recommended_action, CAST(rn AS INTEGER) AS position, rn <= 5 AS selected FROM (
        SELECT *, row_number() OVER (ORDER BY {P}) AS rn FROM marked
        WHERE recommended_action IN ('download_process_load', 'validate_process_load'))""",
        **_PLAN,
    ),
)
def batch_select(spark, sf):
    return B.batch_select(_plan(spark, sf), 5)


@query(
    "batch_action_counts",
    over(
        "raw",
        "SELECT a AS recommended_action, "
        + big("(SELECT count(*) FROM marked WHERE recommended_action = a)", "periods")
        + " FROM (SELECT unnest(["
        + ", ".join(f"'{a}'" for a in B.ACTIONS)
        + "]) AS a)",
        **_PLAN,
    ),
)
def batch_action_counts(spark, sf):
    return B.batch_action_counts(_plan(spark, sf))


def _flagged(cube):
    """Months with an even number lose their '0' flags."""
    flag = F.when((F.expr(MONTH) % 2 == 0) & (F.col("ptpd") == "0"), "no_aplica")
    return cube.withColumn("ptpd", F.coalesce(flag, "ptpd"))


_PASSES = f"{P} < '2001' AND ({MONTH} % 2 = 0 OR count(*) FILTER (WHERE ptpd = '0') = 0)"


@query(
    "control_lifecycle",
    over(
        "facts",
        f"""SELECT {P}, CASE WHEN {_PASSES} THEN 'loaded' ELSE 'pending' END AS status,
        {big(f"CASE WHEN {_PASSES} THEN count(*) END", "row_count")},
        {dbl(f"CASE WHEN {_PASSES} THEN SUM(ta) END", "sum_ta")},
        {dbl(f"CASE WHEN {_PASSES} THEN SUM(masa_sal_ta) END", "sum_masa_sal_ta")},
        CASE WHEN {_PASSES} THEN 'run-2' ELSE 'run-1' END AS run_id FROM facts GROUP BY {P}""",
    ),
)
def control_lifecycle(spark, sf):
    """Register all months, then stage, promote, check and finalise those before 2001; twice.

    Months with an odd number keep their '0' flags, which the checks refuse.
    """
    cube = _flagged(placed_cube(spark, sf))
    tables = FactTables(spark, fresh_path(spark, "facts"))
    for _ in range(2):
        tables.register(_months(spark, sf), "run-1")
        tables.load_staging(cube.filter(F.col(P) < "2001"), tables.control(), "run-1", placed=True)
        tables.promote(tables.control())
        tables.finalize("run-2")
    return tables.control().select(
        P, "status", "row_count", "sum_ta", "sum_masa_sal_ta", "run_id"
    )


_RUN_STATES = f"""SELECT 'run-' || {P} AS run_id, {P}, {P} < '2001' AS promoted,
count(*) FILTER (WHERE ptpd = '0') = 0 OR {MONTH} % 2 = 0 AS clean, count(*) AS n FROM facts GROUP BY 2"""


def _stored_facts(spark, sf, cube):
    """Months registered with a run each; those before 2001 staged, promoted and finalised; twice.

    The tasks of ``cube`` have few months each.
    """
    cube = _flagged(cube)
    tables = FactTables(spark, fresh_path(spark, "facts"))
    months = _months(spark, sf)
    runs = months.select(F.concat(F.lit("run-"), P).alias("run_id"), P)
    for _ in range(2):
        tables.register(months, "run-1")
        # December runs are not registered
        tables.register_runs(runs.filter(F.expr(MONTH) != 12))
        tables.load_staging(cube.filter(F.col(P) < "2001"), tables.control(), "run-1", placed=True)
        tables.promote(tables.control())
        tables.finalize("run-2")
        tables.finalize_runs()
    return tables


@query(
    "manifest_lifecycle",
    over(
        "facts",
        f"""SELECT run_id, CASE WHEN promoted AND clean THEN 'completed' ELSE 'pending' END AS status,
        CASE WHEN promoted AND clean THEN 'final_manifest' ELSE 'manifest_only' END AS run_mode,
        CASE WHEN promoted AND clean THEN 'passed' END AS validation_status,
        CASE WHEN promoted AND clean THEN CAST(n AS VARCHAR) END AS row_count,
        CASE WHEN promoted AND clean THEN {P} END AS period_before,
        {big("CASE WHEN promoted AND clean THEN 2 ELSE 1 END", "states")},
        'pending' AS status_before FROM s WHERE {MONTH} <> 12""",
        s=_RUN_STATES,
    ),
)
def manifest_lifecycle(spark, sf):
    """Stored runs after two rounds: each state once, the one before still inside and readable."""
    tables = _stored_facts(spark, sf, placed_cube(spark, sf))
    states = tables.manifest_log.read().groupBy("run_id").agg(F.count("*").alias("states"))
    first = tables.manifests(as_of=1).select("run_id", F.col("status").alias("status_before"))
    before = F.get_json_object("manifest_json", "$.previous_manifest_json")
    return (
        tables.manifests()
        .join(states, "run_id")
        .join(first, "run_id", "left")
        .select(
            "run_id",
            "status",
            "run_mode",
            F.get_json_object("manifest_json", "$.validation_status").alias("validation_status"),
            F.get_json_object("manifest_json", "$.row_count").alias("row_count"),
            F.get_json_object(before, f"$.{P}").alias("period_before"),
            "states",
            "status_before",
        )
    )


@query(
    "housekeeping_stored",
    over(
        "facts",
        f"""SELECT {P}, {big("n", "csv_rows_detected")}, {big("CASE WHEN promoted THEN n ELSE 0 END", "staging_row_count")},
        {big("CASE WHEN promoted THEN n ELSE 0 END", "final_row_count")},
        CASE WHEN promoted AND clean THEN 'loaded' ELSE 'pending' END AS period_control_status,
        promoted AND clean AND {MONTH} <> 12 AS final_manifest_exists,
        promoted AND clean AND {MONTH} <> 12 AS eligible_for_housekeeping,
        concat_ws(';', CASE WHEN NOT promoted THEN 'staging_exists;final_exists' END,
          CASE WHEN NOT (promoted AND clean) THEN 'period_control_loaded' END,
          CASE WHEN NOT (promoted AND clean AND {MONTH} <> 12) THEN 'final_manifest_exists' END) AS failed_checks
        FROM s""",
        s=_RUN_STATES,
    ),
)
def housekeeping_stored(spark, sf):
    """Which months may be archived, asked of the stored tables: counts and sums are in their logs."""
    # staged and counted: aggregated once, with the columns that staging takes
    wanted = placed_cube(spark, sf).select(*SPEC.keys, *SPEC.sums, *SPEC.fact_ratios)
    with shuffles_freed(spark):
        cube = materialize(wanted, "cube", partition_by=P)
    found = _stored_facts(spark, sf, cube).housekeeping(cube.select(P))
    return found.select(
        P,
        "csv_rows_detected",
        "staging_row_count",
        "final_row_count",
        "period_control_status",
        "final_manifest_exists",
        "eligible_for_housekeeping",
        "failed_checks",
    )
