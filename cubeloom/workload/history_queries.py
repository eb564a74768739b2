"""Fingerprint, comparison, publish and set-operation queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.functions.numbers import exact_sum
from cubeloom.operators import history as H
from cubeloom.operators.audit import fact_constraint_violations, light_period_audit
from cubeloom.operators.cube import cube_aggregate
from cubeloom.operators.normalize import fact_defaults
from cubeloom.plans import series
from cubeloom.session import fresh_path, materialize, shuffles_freed
from cubeloom.sources.tables import PeriodHistory, read_period_table, write_csv, write_parquet
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload.cube_queries import P, rows_with
from cubeloom.workload.landing import FILE_ROWS
from cubeloom.workload.oracle import big, dbl, listed, over
from cubeloom.workload.registry import query
from cubeloom.workload.star_cube import placed_cube, star_cube

_FINGERPRINTED = (*SPEC.fingerprint_counts, *SPEC.fingerprint_amounts)


def _printed_rows(spark, sf):
    return rows_with(spark, sf, SPEC.keys, _FINGERPRINTED)


def _fingerprint_sql(rows: str) -> dict[str, str]:
    """CTEs for the fingerprint of ``rows``: the JSON text is put together by hand."""
    counts = {f"sum_{m}": f"CAST(round_even({m}, 0) AS BIGINT)" for m in SPEC.fingerprint_counts}
    amounts = {f"sum_{m}": f"CAST(CAST({m} AS DECIMAL(38,4)) AS VARCHAR)" for m in SPEC.fingerprint_amounts}
    fields = {P: P, "row_count": "row_count", "distinct_analytic_keys": "distinct_analytic_keys"}
    names = sorted({**fields, **counts, **amounts})
    texts = [
        f"""'"{n}":' || """
        + (f"""'"' || {n} || '"'""" if n == P or n in amounts else f"CAST({n} AS VARCHAR)")
        for n in names
    ]
    payload = "'{' || " + " || ',' || ".join(texts) + " || '}'"
    total = ", ".join(f"coalesce(SUM({m}), 0) AS {m}" for m in _FINGERPRINTED)
    summary = ", ".join(f"{e} AS {n}" for n, e in {**counts, **amounts}.items())
    return {
        f"{rows}_k": f"SELECT {P}, count(*) AS n, {listed(_FINGERPRINTED, 'SUM({0}) AS {0}')} "
        f"FROM {rows} GROUP BY {listed(SPEC.keys)}",
        f"{rows}_s": f"SELECT {P}, CAST(row_count AS BIGINT) AS row_count, "
        f"CAST(distinct_analytic_keys AS BIGINT) AS distinct_analytic_keys, {summary} "
        f"FROM (SELECT {P}, SUM(n) AS row_count, count(*) AS distinct_analytic_keys, {total} "
        f"FROM {rows}_k GROUP BY 1)",
        f"{rows}_f": f"SELECT *, sha256({payload}) AS fingerprint_sha256 FROM {rows}_s",
    }


@query("period_fingerprint", over("norm", "SELECT * FROM norm_f", **_fingerprint_sql("norm")))
def period_fingerprint(spark, sf):
    return H.period_fingerprint(_printed_rows(spark, sf))


# history: 1995 is absent, rows are missing in January 1996, one job more in 1997 on third lines
_OLD_SQL = {
    "old": f"SELECT * REPLACE (CASE WHEN {P} LIKE '1997-%' AND no_trabajadores = 3 THEN ta + 1 "
    f"ELSE ta END AS ta) FROM norm WHERE {P} NOT LIKE '1995-%' "
    f"AND NOT ({P} LIKE '1996-01-%' AND no_trabajadores = 1)"
}
_COMPARE_SQL = {
    **_fingerprint_sql("norm"),
    **_OLD_SQL,
    **_fingerprint_sql("old"),
    "cmp": f"""SELECT n.{P}, n.row_count AS rows_processed,
    n.fingerprint_sha256 AS period_fingerprint_hash, o.row_count AS rows_existing,
    o.fingerprint_sha256 AS existing_hash,
    CASE WHEN o.row_count IS NULL THEN 'new_period'
         WHEN o.row_count <> n.row_count THEN 'conflict_existing_period_row_count'
         WHEN o.fingerprint_sha256 <> n.fingerprint_sha256 THEN 'conflict_existing_period_hash'
         ELSE 'already_exists' END AS comparison_status
    FROM norm_f n LEFT JOIN old_f o ON n.{P} = o.{P}""",
    "req": f"""SELECT *, CASE comparison_status WHEN 'already_exists' THEN 'no_op'
    WHEN 'new_period' THEN 'insert_candidate' ELSE 'block' END AS action FROM cmp
    UNION ALL SELECT '1994-12-31', NULL, NULL, NULL, NULL, 'failed', 'block'""",
}


def _comparison(spark, sf, requested=None):
    rows = _printed_rows(spark, sf)
    period = F.col(P)
    more = period.startswith("1997-") & (F.col("no_trabajadores") == 3)
    old = rows.filter(
        ~period.startswith("1995-")
        & ~(period.startswith("1996-01-") & (F.col("no_trabajadores") == 1))
    ).withColumn("ta", F.when(more, F.col("ta") + 1).otherwise(F.col("ta")))
    new_prints, old_prints = H.period_fingerprint(rows), H.period_fingerprint(old)
    return H.compare_periods(new_prints, old_prints, requested)


@query("period_compare", over("norm", "SELECT * FROM cmp", **_COMPARE_SQL))
def period_compare(spark, sf):
    return _comparison(spark, sf)


@query(
    "publish_plan",
    over(
        "norm",
        f"""SELECT {P}, comparison_status, action,
        CASE WHEN comparison_status = 'failed' THEN 'failed' WHEN action = 'block' THEN 'blocked'
             ELSE 'success' END AS status,
        CASE comparison_status
          WHEN 'already_exists' THEN 'Period already exists in concentrado and matches functionally.'
          WHEN 'new_period' THEN 'Period does not exist in concentrado; dry-run only.'
          WHEN 'conflict_existing_period_hash'
            THEN 'Existing period fingerprint differs from aggregate fingerprint.'
          WHEN 'conflict_existing_period_row_count'
            THEN 'Existing period row count differs from aggregate row count.'
          ELSE 'Comparison failed; publish planning is blocked.' END AS reason
        FROM req""",
        **_COMPARE_SQL,
    ),
)
def publish_plan(spark, sf):
    requested = star_cube(spark, sf, (P,)).unionByName(
        spark.range(1).select(F.lit("1994-12-31").alias(P))
    )
    plan = H.publish_plan(_comparison(spark, sf, requested))
    return plan.select(P, "comparison_status", "action", "status", "reason")


@query(
    "run_status",
    over(
        "norm",
        f"""SELECT 'completed_with_warnings' AS status,
        (SELECT string_agg({P}, ',' ORDER BY {P}) FROM res WHERE s = 'new_period') AS periods_loaded,
        (SELECT string_agg({P}, ',' ORDER BY {P}) FROM res WHERE s = 'already_exists')
          AS periods_existing,
        (SELECT string_agg({P}, ',' ORDER BY {P}) FROM res WHERE s LIKE 'conflict%')
          AS periods_conflict,
        (SELECT string_agg({P}, ',' ORDER BY {P}) FROM res WHERE s = 'failed') AS periods_failed,
        {big("(SELECT SUM(rows_processed) FROM res WHERE s = 'new_period')", "rows_loaded")},
        {big("(SELECT SUM(rows_processed) FROM res WHERE s <> 'new_period')", "rows_not_loaded")}""",
        **_COMPARE_SQL,
        # repeated keys fail the audit of a month
        dup=f"SELECT DISTINCT {P} FROM norm GROUP BY {listed(SPEC.keys)} HAVING count(*) > 1",
        res=f"""SELECT *, CASE WHEN {P} IN (FROM dup) OR {P} = '1994-12-31' THEN 'failed'
        ELSE comparison_status END AS s FROM req""",
    ),
)
def run_status(spark, sf):
    """One run over all months: new, known, conflicting and one that was not delivered."""
    absent = spark.range(1).select(F.lit("1994-12-31").alias(P))
    requested = star_cube(spark, sf, (P,)).unionByName(absent)
    rows = rows_with(spark, sf, SPEC.keys, SPEC.measures)
    audit = light_period_audit(rows, requested)
    return H.run_status(H.period_results(_comparison(spark, sf, requested), audit))


_DELIVERED = {
    "one": f"SELECT {P} FROM norm WHERE {P} = '1998-06-30'",
    "two": f"SELECT {P} FROM norm WHERE {P} LIKE '1998-%'",
}


@query(
    "aggregate_pre_checks",
    over(
        "norm",
        f"""SELECT '1998-06-30' AS {P}, {big("(SELECT count(*) FROM one)", "row_count")}, '' AS errors
        UNION ALL SELECT '1998-07-31', (SELECT count(*) FROM one),
        'aggregate period does not match requested period: 1998-06-30'
        UNION ALL SELECT '1998-06-30', (SELECT count(*) FROM two),
        'aggregate contains multiple periods'
        UNION ALL SELECT '1998-06-30', NULL,
        'Aggregate file is missing required columns: sexo, ptpd'
        UNION ALL SELECT '1998-06-30', (SELECT count(*) FROM one),
        'aggregate and concentrado columns do not match exactly'""",
        **_DELIVERED,
    ),
)
def aggregate_pre_checks(spark, sf):
    """A month asked for by its own and by another name, a year, and two odd layouts."""
    rows = _printed_rows(spark, sf)
    june = rows.filter(F.col(P) == "1998-06-30")
    asked = "1998-06-30"
    checks = [
        H.aggregate_pre_checks(june, asked, rows.columns),
        H.aggregate_pre_checks(june, "1998-07-31"),
        H.aggregate_pre_checks(rows.filter(F.col(P).startswith("1998-")), asked),
        H.aggregate_pre_checks(june.drop("sexo", "ptpd"), asked),
        H.aggregate_pre_checks(june, asked, rows.columns[::-1]),
    ]
    return reduce(DataFrame.unionByName, checks)


@query(
    "fact_constraints",
    over(
        "norm",
        f"""SELECT {P}, 'unique_analytic_key' AS constraint, {big("SUM(n)", "filas")} FROM g
        WHERE n > 1 GROUP BY 1 UNION ALL
        SELECT {P}, 'accepted_ptpd', {big("SUM(n)", "filas")} FROM g
        WHERE ptpd NOT IN ('0', '1', 'no_disponible', 'no_aplica') GROUP BY 1""",
        f=f"""SELECT * REPLACE (CASE WHEN {P} LIKE '1999-%' AND ptpd = '0' THEN '2'
        ELSE coalesce(ptpd, 'no_disponible') END AS ptpd) FROM norm
        UNION ALL SELECT * REPLACE (coalesce(ptpd, 'no_disponible') AS ptpd) FROM norm
        WHERE ta > 45 AND {P} LIKE '1998-%'""",
        g=f"SELECT {P}, ptpd, count(*) AS n FROM f GROUP BY {listed(SPEC.keys)}",
    ),
)
def fact_constraints(spark, sf):
    """Facts with repeated keys in 1998 and an unknown flag in 1999."""
    rows = fact_defaults(rows_with(spark, sf, SPEC.keys, ("ta",)))
    again = rows.filter((F.col("ta") > 45) & F.col(P).startswith("1998-"))
    odd = F.when(F.col(P).startswith("1999-") & (F.col("ptpd") == "0"), "2")
    flagged = rows.withColumn("ptpd", F.coalesce(odd, F.col("ptpd")))
    return fact_constraint_violations(flagged.unionByName(again))


# ---------------------------------------------------------------- tables


def _cube(spark, sf):
    return cube_aggregate(star_cube(spark, sf))


def _stored_cube(spark, sf):
    """Aggregated once, for queries that deliver it more than once."""
    with shuffles_freed(spark):
        return materialize(placed_cube(spark, sf), "cube", partition_by=P)


_STORED = f"SELECT {P}, count(*) AS n, SUM(ta) AS ta, SUM(masa_sal_ta) AS m FROM cube GROUP BY 1"


@query(
    "insert_only_history",
    over(
        "cube",
        f"""SELECT {P}, CASE WHEN {P} < '1998-01' THEN 'already_exists' ELSE 'success_loaded' END
        AS status, {big("n", "rows_processed")},
        {big(f"CASE WHEN {P} < '1998-01' THEN 0 ELSE n END", "rows_loaded")},
        {big("n", "rows_in_history")}, {dbl("ta", "ta")}, {dbl("m", "masa_sal_ta")} FROM g""",
        g=_STORED,
    ),
)
def insert_only_history(spark, sf):
    """Publish the months before 1998, then all: the old ones stay, the new ones are added."""
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    cube = _stored_cube(spark, sf)
    history.publish(cube.filter(F.col(P) < "1998-01"), placed=True)
    results, _ = history.publish(cube, placed=True)
    stored = history.read().groupBy(P).agg(
        F.count("*").alias("rows_in_history"),
        exact_sum(F.col("ta")).alias("ta"),
        exact_sum(F.col("masa_sal_ta")).alias("masa_sal_ta"),
    )
    return results.join(stored, P).select(
        P,
        "status",
        "rows_processed",
        "rows_loaded",
        "rows_in_history",
        "ta",
        "masa_sal_ta",
    )


@query(
    "publish_post_checks",
    over(
        "cube",
        f"""SELECT {P}, {big("0", "rows_before")}, {big("n", "rows_inserted")},
        {big("n", "rows_after")}, 'success' AS status, 'passed' AS validation_status,
        '' AS error_message FROM g WHERE {P} >= '1999'""",
        g=_STORED,
    ),
)
def publish_post_checks(spark, sf):
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    cube = _stored_cube(spark, sf)
    history.publish(cube.filter(F.col(P) < "1999"), placed=True)
    return history.publish_checked(cube, placed=True)


_BLOCKED = f"""SELECT {P}, {{before}} AS rows_before, {big("0", "rows_inserted")},
{{before}} AS rows_after, 'blocked' AS status, 'blocked' AS validation_status,
'{{message}}' AS error_message FROM g WHERE {{months}}"""


@query(
    "publish_column_guard",
    over(
        "cube",
        _BLOCKED.format(
            before=f"CAST(CASE WHEN {P} < '1999' THEN n ELSE 0 END AS BIGINT)",
            message=H.MESSAGES["other_columns"],
            months=f"{P} >= '1998'",
        ),
        g=_STORED,
    ),
)
def publish_column_guard(spark, sf):
    """The same columns in another order: a guarded publish blocks all months, new and known."""
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    cube = placed_cube(spark, sf)
    history.publish(cube.filter(F.col(P) < "1999"), placed=True)
    swapped = cube.select(*cube.columns[:-2], cube.columns[-1], cube.columns[-2])
    return history.publish_checked(swapped.filter(F.col(P) >= "1998"), placed=True)


@query(
    "publish_header_guard",
    over(
        "cube",
        _BLOCKED.format(
            before="CAST(0 AS BIGINT)", message=H.MESSAGES["header_row"], months=f"{P} >= '1999'"
        )
        + f" UNION ALL SELECT {P}, {big('n', 'a')}, {big('0', 'b')}, {big('n', 'c')}, 'stored', 'stored', '' "
        f"FROM g WHERE {P} < '1998'",
        g=_STORED,
    ),
)
def publish_header_guard(spark, sf):
    """A delivery whose CSV files were joined with their header lines is blocked whole."""
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    cube, path = placed_cube(spark, sf), fresh_path(spark, "delivery")
    history.publish(cube.filter(F.col(P) < "1998"), placed=True)
    write_csv(cube.filter(F.col(P) >= "1999"), path, file_rows=FILE_ROWS)
    # read as text without a header, so the header line of every file is a row
    texts = ", ".join(f"`{c}` string" for c in cube.columns)
    delivery = spark.read.schema(texts).csv(path, escape='"')
    blocked = history.publish_checked(delivery, placed=True)
    stored = history.read().groupBy(P).agg(F.count("*").alias("n"))
    kept = stored.select(
        P,
        F.col("n").alias("rows_before"),
        F.lit(0).cast("bigint").alias("rows_inserted"),
        F.col("n").alias("rows_after"),
        F.lit("stored").alias("status"),
        F.lit("stored").alias("validation_status"),
        F.lit("").alias("error_message"),
    )
    return blocked.unionByName(kept)


@query(
    "stored_snapshot",
    over(
        "cube",
        f"""SELECT CAST({P} AS DATE) AS periodo, cve_entidad, sexo, {dbl("SUM(ta)", "asegurados")}
        FROM cube WHERE {P} = (SELECT MAX({P}) FROM cube) GROUP BY 1, 2, 3""",
    ),
)
def stored_snapshot(spark, sf):
    """The last month of a published history: its name is in the log, only its folder is read."""
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    history.publish(placed_cube(spark, sf), placed=True)
    return series.latest_snapshot(history.read_last(), "ta", ["cve_entidad", "sexo"])


_SCANNED = (*SPEC.keys, "ta", "masa_sal_ta", "sbc_total")


@query(
    "history_period_scan",
    over(
        "cube",
        f"""SELECT {listed(SPEC.keys)}, {dbl("ta", "ta")}, {dbl("masa_sal_ta", "masa_sal_ta")},
        CAST(masa_sal_ta AS DOUBLE) / NULLIF(CAST(ta_sal AS DOUBLE), 0) AS sbc_total
        FROM cube WHERE {P} = '1998-06-30'""",
    ),
)
def history_period_scan(spark, sf):
    """One month of a period-partitioned table: the scan opens its folder only."""
    path = fresh_path(spark, "periods")
    write_parquet(placed_cube(spark, sf), path, partition_by=P)
    return read_period_table(spark, path, "1998-06-30").select(*_SCANNED)


@query(
    "parquet_roundtrip",
    over(
        "cube",
        f"SELECT {listed(SPEC.keys)}, {dbl('ta', 'ta')}, {dbl('masa_sal_ta', 'masa_sal_ta')} FROM cube",
    ),
)
def parquet_roundtrip(spark, sf):
    path = fresh_path(spark, "cube")
    write_parquet(_cube(spark, sf).select(*SPEC.keys, "ta", "masa_sal_ta"), path, codec="zstd")
    return spark.read.parquet(path)


# ---------------------------------------------------------------- set operations

_WIDE = (*SPEC.keys, *SPEC.measures)
_WIDE_SQL = f"""{listed(SPEC.keys)}, {listed(SPEC.measures, "CAST({0} AS DOUBLE) AS {0}")}"""


@query(
    "dedup_ignore_metadata",
    over(
        "norm",
        f"""SELECT {_WIDE_SQL}, CASE WHEN {P} < '1999' THEN 'run-1' ELSE 'run-2' END AS timestamp
        FROM (SELECT DISTINCT {listed(_WIDE)} FROM norm)""",
    ),
)
def dedup_ignore_metadata(spark, sf):
    """Two runs that overlap before 1999: the first one's rows win."""
    rows = rows_with(spark, sf, SPEC.keys, SPEC.measures).select(*_WIDE)
    first = rows.filter(F.col(P) < "1999").withColumn("timestamp", F.lit("run-1"))
    second = rows.withColumn("timestamp", F.lit("run-2"))
    return H.dedup_ignore_metadata(first, second)


@query(
    "set_difference",
    over(
        "norm",
        f"""SELECT {_WIDE_SQL} FROM (
        SELECT {listed(_WIDE)} FROM norm EXCEPT ALL
        SELECT {listed(_WIDE)} FROM norm WHERE no_trabajadores < 3 OR {P} LIKE '1999-%')""",
    ),
)
def set_difference(spark, sf):
    rows = rows_with(spark, sf, SPEC.keys, SPEC.measures).select(*_WIDE)
    part = rows.filter((F.col("no_trabajadores") < 3) | F.col(P).startswith("1999-"))
    stamped = rows.withColumn("timestamp", F.lit("a"))
    return H.multiset_difference(stamped, part.withColumn("timestamp", F.lit("b")), ("timestamp",))


_LEFT = "SELECT * FROM norm WHERE no_trabajadores > 1 UNION ALL SELECT * FROM norm WHERE ta > 48"
_RIGHT = (
    f"SELECT * REPLACE (CASE WHEN {P} LIKE '1999-%' AND ta = 7 THEN masa_sal_ta + 1 ELSE masa_sal_ta END "
    "AS masa_sal_ta) FROM norm WHERE no_trabajadores < 6"
)


@query(
    "set_difference_both",
    over(
        "norm",
        f"""SELECT side, {_WIDE_SQL}, {big("count(*)", "copies")}
        FROM (SELECT 'left' AS side, * FROM (SELECT {listed(_WIDE)} FROM a EXCEPT ALL SELECT {listed(_WIDE)} FROM b)
        UNION ALL
        SELECT 'right' AS side, * FROM (SELECT {listed(_WIDE)} FROM b EXCEPT ALL SELECT {listed(_WIDE)} FROM a))
        GROUP BY ALL""",
        a=_LEFT,
        b=_RIGHT,
    ),
)
def set_difference_both(spark, sf):
    """Two files of one delivery over all keys and measures; what only one of them has, counted."""
    # both files are made of these rows, which are joined once and read three times
    rows = materialize(rows_with(spark, sf, SPEC.keys, SPEC.measures).select(*_WIDE), "delivery")
    line, jobs = F.col("no_trabajadores"), F.col("ta")
    left = rows.filter(line > 1).unionByName(rows.filter(jobs > 48)).withColumn("timestamp", F.lit("a"))
    dearer = F.col(P).startswith("1999-") & (jobs == 7)
    right = rows.filter(line < 6).withColumns(
        {
            "masa_sal_ta": F.when(dearer, F.col("masa_sal_ta") + 1).otherwise(F.col("masa_sal_ta")),
            "timestamp": F.lit("b"),
        }
    )
    return H.multiset_differences(left, right, ignore=("timestamp",))
