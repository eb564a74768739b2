"""Queries over raw files: layouts, validation, typed scan, drift and incremental ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cubeloom.functions.numbers import exact_sum, number_column
from cubeloom.operators.audit import layout_report as report_layout
from cubeloom.operators.cube import cube_aggregate, merge_cubes
from cubeloom.session import fresh_path
from cubeloom.sources import raw_files as R
from cubeloom.sources.tables import PeriodHistory, write_csv
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.streaming.ingest import ingest_available
from cubeloom.workload.cube_queries import P, SMALL
from cubeloom.workload.landing import MID_END, OLD_END, read_sql, write_landing
from cubeloom.workload.oracle import CUBE_SQL, NORM_SQL, big, dbl, listed, over
from cubeloom.workload.registry import query
from cubeloom.workload.star_cube import star_cube


def _layouts(spark, sf):
    root = write_landing(spark, sf, broken=True)
    return R.resolve_layouts(R.header_lines(R.list_files(spark, root)))


_LAYOUT = f"""CASE WHEN {P} < '{OLD_END}' THEN 'old' WHEN {P} < '{MID_END}' THEN 'mid' ELSE 'full' END"""
_FILES = f"SELECT DISTINCT {P}, {_LAYOUT} AS layout FROM raw"
_MISSING_2 = ",".join(c for c in SPEC.required_in_files if c not in ("sexo", "ta", "masa_sal_ta"))
_MISSING_ALL = ",".join(SPEC.required_in_files)


@query(
    "layout_resolution",
    over(
        "raw",
        f"""SELECT {P}, CASE WHEN layout = 'old' THEN 'latin-1' ELSE 'utf-8-sig' END
        AS encoding_detected, '|' AS delimiter,
        CAST(CASE layout WHEN 'old' THEN 28 WHEN 'mid' THEN 29 ELSE 30 END AS INTEGER)
        AS column_count, '' AS missing_required_columns, CAST(NULL AS VARCHAR) AS reason FROM f
        UNION ALL SELECT '2031-01-31', NULL, ';', 0, '{_MISSING_ALL}', 'invalid_separator'
        FROM (SELECT DISTINCT {P} FROM raw WHERE {P} = '1998-01-31')
        UNION ALL SELECT '2031-02-28', NULL, '|', 3, '{_MISSING_2}', 'missing_required_columns'
        FROM (SELECT DISTINCT {P} FROM raw WHERE {P} = '1998-02-28')""",
        f=_FILES,
    ),
)
def layout_resolution(spark, sf):
    """One row per period: its files have one layout."""
    return (
        _layouts(spark, sf)
        .select(
            P,
            "encoding_detected",
            "delimiter",
            F.size("columns").alias("column_count"),
            F.array_join("missing_required_columns", ",").alias("missing_required_columns"),
            "reason",
        )
        .distinct()
    )


@query(
    "raw_file_report",
    over(
        "raw",
        f"""SELECT {P}, 'success' AS status, true AS valid FROM f
        UNION ALL SELECT '2031-01-31', 'failed_invalid_separator', false
        FROM (SELECT DISTINCT {P} FROM raw WHERE {P} = '1998-01-31')
        UNION ALL SELECT '2031-02-28', 'failed_missing_required_columns', false
        FROM (SELECT DISTINCT {P} FROM raw WHERE {P} = '1998-02-28')
        UNION ALL SELECT '2031-03-31', 'failed_missing_raw', false""",
        f=_FILES,
    ),
)
def raw_file_report(spark, sf):
    """Requested: the delivered months and one without a file."""
    found = _layouts(spark, sf)
    absent = spark.range(1).select(F.lit("2031-03-31").alias(P))
    report = R.raw_file_report(found, found.select(P).unionByName(absent))
    return report.select(P, "status", "valid").distinct()


_CHECKED = tuple(c for c in SPEC.layout_columns if c in (*SPEC.raw_dims, *SPEC.measures))


@query(
    "layout_report",
    over(
        "raw",
        f"""SELECT f.{P}, c.column_name, p.present, c.forbidden,
        CASE WHEN c.forbidden THEN 'absent_ok' WHEN p.present THEN 'present' ELSE 'missing' END
        AS status FROM f, (SELECT unnest([{", ".join(f"'{c}'" for c in SPEC.layout_columns)}])
        AS column_name, false AS forbidden UNION ALL SELECT 'sector_economico_3', true) c,
        LATERAL (SELECT c.column_name IN ({", ".join(f"'{c}'" for c in _CHECKED)})
        AND NOT (c.column_name = 'ptpd' AND f.layout <> 'full') AS present) p""",
        f=_FILES,
    ),
)
def layout_report(spark, sf):
    """Published columns looked up in the raw headers of every month, so some are missing."""
    root = write_landing(spark, sf)
    headers = R.resolve_layouts(R.header_lines(R.list_files(spark, root)))
    by_month = headers.select(F.col(P).alias("path"), "columns").distinct()
    return report_layout(by_month).withColumnRenamed("path", P)


_SCANNED = SPEC.measures


@query(
    "raw_scan_cast",
    over(
        "raw",
        f"""SELECT "{P}", {listed(SPEC.raw_dims)},
        {listed(_SCANNED, "CAST({0} AS DOUBLE) AS {0}")} FROM files""",
        files=read_sql(),
    ),
)
def raw_scan_cast(spark, sf):
    """Files of all layouts as typed rows: tokens and bad numbers are null."""
    raw = R.read_raw(spark, write_landing(spark, sf))
    return raw.select(P, *SPEC.raw_dims, *[number_column(raw, m).alias(m) for m in _SCANNED])


@query(
    "malformed_rows_report",
    over(
        "raw",
        f"""SELECT "{P}", {big("count(*)", "filas")},
        {big("count(*) FILTER (WHERE no_trabajadores = 7)", "filas_malformadas")}
        FROM raw GROUP BY 1""",
    ),
)
def malformed_rows_report(spark, sf):
    """Seventh lines have a field too many or, for one status, too few."""
    root = write_landing(spark, sf, malformed=True)
    return R.malformed_rows_report(spark, root).drop("ejemplo")


@query(
    "legacy_scan",
    over(
        "raw",
        f"""SELECT "{P}", CASE WHEN no_trabajadores = 2 AND rango_salarial = 'W1' THEN 'NA'
        ELSE nullif(sexo, '') END AS sexo, {big("count(*)", "filas")} FROM raw GROUP BY 1, 2""",
    ),
)
def legacy_scan(spark, sf):
    """The older loader: only empty texts are missing."""
    raw = R.read_raw(spark, write_landing(spark, sf), na_tokens=("",))
    return raw.groupBy(P, "sexo").agg(F.count("*").alias("filas"))


@query(
    "inferred_scan",
    over(
        "raw",
        f"""SELECT sexo, typeof(1::INTEGER) = 'INTEGER' AS sexo_is_number,
        {big("count(*)", "filas")}, {dbl("SUM(ta)", "ta")} FROM raw GROUP BY 1""",
    ).replace("SELECT sexo, typeof", "SELECT CAST(sexo AS INTEGER) AS sexo, typeof"),
)
def inferred_scan(spark, sf):
    """Types from all rows of a file: a code becomes a number."""
    path = fresh_path(spark, "inferred")
    write_csv(star_cube(spark, sf, (P, "sexo", "ta")), path)
    rows = R.read_inferred(spark, path)
    is_number = dict(rows.dtypes)["sexo"] == "int"
    return rows.groupBy("sexo").agg(
        F.lit(is_number).alias("sexo_is_number"),
        F.count("*").alias("filas"),
        exact_sum(F.col("ta")).alias("ta"),
    )


@query(
    "csv_roundtrip",
    over(
        "raw",
        f"""SELECT {listed((P, *SPEC.raw_dims), "nullif({0}, '') AS {0}")},
        {dbl("ta", "ta")}, {dbl("masa_sal_ta", "masa_sal_ta")} FROM raw""",
    ),
)
def csv_roundtrip(spark, sf):
    """The CSV sink writes what a typed reader gets back; empty texts come back as missing."""
    columns = (P, *SPEC.raw_dims, "ta", "masa_sal_ta")
    rows = star_cube(spark, sf, columns)
    path = fresh_path(spark, "csv")
    write_csv(rows, path)
    return spark.read.schema(rows.schema).csv(path, header=True, escape='"')


@query(
    "period_from_path",
    over("raw", f'SELECT "{P}", {big("count(*)", "filas")} FROM raw GROUP BY 1'),
)
def period_from_path(spark, sf):
    raw = R.read_raw(spark, write_landing(spark, sf))
    return raw.groupBy(P).agg(F.count("*").alias("filas"))


@query(
    "file_cube",
    over(
        "raw",
        f"SELECT {listed(SPEC.keys)}, {listed(SPEC.sums, 'CAST({0} AS DOUBLE) AS {0}')} FROM cube",
        files=read_sql(),
        norm=NORM_SQL.replace("FROM raw", "FROM files"),
        cube=CUBE_SQL,
    ),
)
def file_cube(spark, sf):
    """The whole way: files of drifting layouts to one cube."""
    cube = cube_aggregate(R.read_raw(spark, write_landing(spark, sf)))
    return cube.select(*SPEC.keys, *SPEC.sums)


_DRIFT = (P, "sexo", "rango_uma", "ptpd")


@query(
    "union_drifting_layouts",
    over(
        "raw",
        f"""SELECT "{P}", sexo, CASE WHEN "{P}" >= '{OLD_END}' THEN rango_uma END AS rango_uma,
        CASE WHEN "{P}" >= '{MID_END}' THEN ptpd END AS ptpd, {big("count(*)", "filas")},
        {dbl("SUM(ta)", "ta")} FROM raw GROUP BY 1, 2, 3, 4""",
    ),
)
def union_drifting_layouts(spark, sf):
    """Three layouts by column name; what a layout lacks is null."""
    rows = star_cube(spark, sf, (*_DRIFT, "ta"))
    period = F.col(P)
    old = rows.filter(period < OLD_END).drop("rango_uma", "ptpd")
    mid = rows.filter((period >= OLD_END) & (period < MID_END)).drop("ptpd")
    full = rows.filter(period >= MID_END)
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (full, mid, old))
    return union.groupBy(*_DRIFT).agg(F.count("*").alias("filas"), exact_sum(F.col("ta")).alias("ta"))


@query(
    "merge_drifting_partials",
    over(
        "norm",
        f"""SELECT {P}, cve_entidad, sexo, rango_ingreso_vsm, sector_economico_1,
        {dbl("SUM(ta)", "ta")}, {dbl("SUM(masa_sal_ta)", "masa_sal_ta")}
        FROM norm GROUP BY 1, 2, 3, 4, 5""",
    ),
)
def merge_drifting_partials(spark, sf):
    """Partial cubes of different columns, written one by one, read together and merged."""
    raw = star_cube(spark, sf, (P, *SMALL.raw_dims, *SMALL.measures))
    path = fresh_path(spark, "partials")
    for i in range(2):
        part = cube_aggregate(raw.filter(F.col("no_trabajadores") % 2 == i), SMALL)
        # the first delivery knows no payroll by contract, the second no counts of workers
        absent = ("masa_sal_tpu", "masa_sal_tpc") if i == 0 else ("no_trabajadores",)
        kept = part.select(*SMALL.keys, *[c for c in SMALL.sums if c not in absent])
        kept.write.option("compression", "zstd").parquet(f"{path}/part={i}")
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    return merge_cubes(stored, spec=SMALL).select(*SMALL.keys, "ta", "masa_sal_ta")


@query(
    "incremental_ingest",
    over(
        "raw",
        f"""SELECT {P}, {big("count(*)", "filas")},
        {listed(SPEC.sums, "CAST(SUM({0}) AS DOUBLE) AS {0}")} FROM cube GROUP BY 1""",
        files=read_sql(),
        norm=NORM_SQL.replace("FROM raw", "FROM files"),
        cube=CUBE_SQL,
    ),
)
def incremental_ingest(spark, sf):
    """Files of three layouts as a stream, in micro-batches, started twice: nothing comes twice."""
    landing = write_landing(spark, sf)
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    checkpoint = fresh_path(spark, "ingest")
    for _ in range(2):
        ingest_available(spark, landing, checkpoint, history, max_files_per_trigger=64)
    return history.read().groupBy(P).agg(
        F.count("*").alias("filas"), *[exact_sum(F.col(c)).alias(c) for c in SPEC.sums]
    )


_LATE = "SELECT * FROM {0} WHERE {1} LIKE '1998-%' AND no_trabajadores = 7"
_AGAIN = "SELECT * FROM {0} WHERE {1} LIKE '1999-%' AND no_trabajadores = 1"


def _cube_of(rows: str) -> str:
    return CUBE_SQL.replace("FROM norm", f"FROM {rows}")


@query(
    "late_files",
    over(
        "raw",
        f"""SELECT a.{P}, CASE WHEN b.n <> a.n THEN 'conflict_existing_period_row_count'
          ELSE 'conflict_existing_period_hash' END AS status, {big("b.n", "rows_processed")},
          {big("a.n", "rows_existing")}, {big("0", "rows_loaded")}, {big("a.n", "rows_in_history")}
        FROM (SELECT {P}, count(*) AS n FROM before GROUP BY 1) a
        JOIN (SELECT {P}, count(*) AS n FROM after GROUP BY 1) b USING ({P})
        WHERE {P} LIKE '1998-%' OR {P} LIKE '1999-%'""",
        files=read_sql(),
        norm=NORM_SQL.replace("FROM raw", "FROM files"),
        first=f"SELECT * FROM norm WHERE NOT ({P} LIKE '1998-%' AND no_trabajadores = 7)",
        whole=f"SELECT * FROM norm UNION ALL {_AGAIN.format('norm', P)}",
        before=_cube_of("first"),
        after=_cube_of("whole"),
    ),
)
def late_files(spark, sf):
    """Files that come for published months: seventh lines of 1998, and lines of 1999 once more.

    The first kind adds rows to the months' cubes, the second changes their sums only.
    """
    line, period = F.col("no_trabajadores"), F.col(P)
    late = period.startswith("1998-") & (line == 7)
    again = period.startswith("1999-") & (line == 1)
    landing = write_landing(spark, sf, only=~late)
    history = PeriodHistory(spark, fresh_path(spark, "history"))
    checkpoint = fresh_path(spark, "ingest")
    ingest_available(spark, landing, checkpoint, history)
    write_landing(spark, sf, only=late | again, root=f"{landing}/more")
    results, _ = ingest_available(spark, landing, checkpoint, history)
    stored = history.read().groupBy(P).agg(F.count("*").alias("rows_in_history"))
    return results.join(stored, P).select(
        P, "status", "rows_processed", "rows_existing", "rows_loaded", "rows_in_history"
    )


@query(
    "quoted_breaks_scan",
    over(
        "raw",
        f"""SELECT "{P}", CASE WHEN no_trabajadores = 5 THEN cve_municipio || chr(10) || '|' || sexo
        ELSE nullif(cve_municipio, '') END AS cve_municipio, {big("count(*)", "filas")},
        {dbl("SUM(masa_sal_teu)", "masa_sal_teu")} FROM raw GROUP BY 1, 2""",
    ),
)
def quoted_breaks_scan(spark, sf):
    """Fields that hold a line break and a separator, in files of every layout."""
    raw = R.read_raw(spark, write_landing(spark, sf, breaks=True))
    return raw.groupBy(P, "cve_municipio").agg(
        F.count("*").alias("filas"), exact_sum(number_column(raw, "masa_sal_teu")).alias("masa_sal_teu")
    )
