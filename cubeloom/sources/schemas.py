"""Table schemas: staging, facts, control, run manifests and the dimension catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cubeloom.operators.normalize import STAGING_METADATA
from cubeloom.spec import DEFAULT_SPEC, CubeSpec

# Columns of the period-level tables and of the nine catalogues.
CONTROL = (
    "periodo_informacion string, status string, row_count bigint, "
    "period_fingerprint_hash string, sum_asegurados double, sum_no_trabajadores double, "
    "sum_ta double, sum_ta_sal double, sum_masa_sal_ta double, run_id string, "
    "source_url string, loaded_at timestamp, error_message string"
)
MANIFESTS = (
    "run_id string, run_mode string, started_at timestamp, finished_at timestamp, "
    "status string, config_hash_sha256 string, manifest_json string, created_at timestamp"
)
CATALOGS = {
    "cat_genero": "sexo string, descripcion string, activo boolean",
    "cat_ptpd": "ptpd string, descripcion string, activo boolean",
    "cat_rango_edad": "rango_edad string, descripcion string, orden int, activo boolean",
    "cat_rango_ingreso_vsm": "rango_ingreso_vsm string, descripcion string, orden int, activo boolean",
    "cat_rango_ingreso_uma": "rango_ingreso_uma string, descripcion string, orden int, activo boolean",
    "cat_sector_economico_1": "sector_economico_1 string, descripcion string, activo boolean",
    "cat_sector_economico_2": "sector_economico_2 string, sector_economico_1 string, "
    "descripcion string, activo boolean",
    "cat_sector_economico_4": "sector_economico_4 string, sector_economico_2 string, "
    "sector_economico_1 string, descripcion string, activo boolean",
    "cat_entidad_municipio": "cve_entidad string, cve_municipio string, entidad string, "
    "municipio string, activo boolean",
}


def staging_schema(spec: CubeSpec = DEFAULT_SPEC) -> str:
    """Staging and facts share their columns; facts have defaults instead of nulls."""
    texts = ("run_id", *spec.keys)
    numbers = (*spec.sums, *spec.fact_ratios)
    fields = [f"`{c}` string" for c in texts]
    fields += [f"`{c}` double" for c in numbers]
    fields += [f"`{c}` string" for c in STAGING_METADATA]
    return ", ".join(fields)


def empty_table(spark: SparkSession, name: str, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """A table to start from: 'staging', 'facts', 'control', 'manifests' or a catalogue."""
    known = {
        "staging": staging_schema(spec),
        "facts": staging_schema(spec),
        "control": CONTROL,
        "manifests": MANIFESTS,
        **CATALOGS,
    }
    return spark.createDataFrame([], known[name])
