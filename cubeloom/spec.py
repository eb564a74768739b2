"""Description of a period cube: keys, measures, formulas and value rules.

Every operator takes a :class:`CubeSpec`, so another monthly cube can be served
by building another spec.  ``DEFAULT_SPEC`` is the social-security jobs cube.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: column names, formulas, labels and tokens of the data model ----

RAW_DIMS = (
    "cve_delegacion",
    "cve_subdelegacion",
    "cve_entidad",
    "cve_municipio",
    "tamaño_patron",
    "sexo",
    "rango_edad",
    "rango_salarial",
    "rango_uma",
    "sector_economico_1",
    "sector_economico_2",
    "sector_economico_4",
    "ptpd",
)

MEASURES = (
    "asegurados",
    "no_trabajadores",
    "ta",
    "ta_sal",
    "tpu",
    "tpc",
    "teu",
    "tec",
    "tpu_sal",
    "tpc_sal",
    "teu_sal",
    "tec_sal",
    "masa_sal_ta",
    "masa_sal_tpu",
    "masa_sal_tpc",
    "masa_sal_teu",
    "masa_sal_tec",
)

DERIVED_SUMS = {
    "puestos_permanentes": ("tpu", "tpc"),
    "puestos_eventuales": ("teu", "tec"),
    "puestos_urbanos": ("tpu", "teu"),
    "puestos_campo": ("tpc", "tec"),
    "masa_sal_permanentes": ("masa_sal_tpu", "masa_sal_tpc"),
    "masa_sal_eventuales": ("masa_sal_teu", "masa_sal_tec"),
    "masa_sal_urbanos": ("masa_sal_tpu", "masa_sal_teu"),
    "masa_sal_campo": ("masa_sal_tpc", "masa_sal_tec"),
}

RATIOS = {
    "sbc_total": (("masa_sal_ta",), ("ta_sal",)),
    "sbc_permanente_urbano": (("masa_sal_tpu",), ("tpu_sal",)),
    "sbc_permanente_campo": (("masa_sal_tpc",), ("tpc_sal",)),
    "sbc_eventual_urbano": (("masa_sal_teu",), ("teu_sal",)),
    "sbc_eventual_campo": (("masa_sal_tec",), ("tec_sal",)),
    "sbc_permanentes": (("masa_sal_tpu", "masa_sal_tpc"), ("tpu_sal", "tpc_sal")),
    "sbc_eventuales": (("masa_sal_teu", "masa_sal_tec"), ("teu_sal", "tec_sal")),
    "sbc_urbanos": (("masa_sal_tpu", "masa_sal_teu"), ("tpu_sal", "teu_sal")),
    "sbc_campo": (("masa_sal_tpc", "masa_sal_tec"), ("tpc_sal", "tec_sal")),
}

DIFFERENCES = {
    "diff_ta_componentes": (("ta",), ("tpu", "tpc", "teu", "tec")),
    "diff_masa_sal_componentes": (
        ("masa_sal_ta",),
        ("masa_sal_tpu", "masa_sal_tpc", "masa_sal_teu", "masa_sal_tec"),
    ),
    "diff_asegurados_ta_no_trabajadores": (("asegurados",), ("ta", "no_trabajadores")),
}

# Text that the default CSV reader of pandas turns into null.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

CONTROL_STATUSES = (
    "pending",
    "loaded",
    "already_exists",
    "conflict_existing_period_row_count",
    "conflict_existing_period_hash",
    "failed_validation",
    "failed_load",
)

# ---- end of fixed values ----


@dataclass(frozen=True)
class CubeSpec:
    period: str = "periodo_informacion"
    raw_dims: tuple[str, ...] = RAW_DIMS
    optional_in_files: tuple[str, ...] = ("rango_uma", "ptpd")
    measures: tuple[str, ...] = MEASURES
    renamed_dims: dict[str, str] = field(
        default_factory=lambda: {
            "rango_salarial": "rango_ingreso_vsm",
            "rango_uma": "rango_ingreso_uma",
        }
    )
    derived_sums: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(DERIVED_SUMS))
    ratios: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(
        default_factory=lambda: dict(RATIOS)
    )
    differences: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(
        default_factory=lambda: dict(DIFFERENCES)
    )
    # value rules
    label_dims: tuple[str, ...] = (
        "cve_municipio",
        "tamaño_patron",
        "rango_edad",
        "rango_ingreso_vsm",
    )
    blank_label: str = "NA"
    sector_dims: tuple[str, ...] = (
        "sector_economico_1",
        "sector_economico_2",
        "sector_economico_4",
    )
    integer_code_dims: tuple[str, ...] = (
        "cve_delegacion",
        "cve_subdelegacion",
        "cve_entidad",
        "sector_economico_1",
        "sector_economico_2",
        "sector_economico_4",
    )
    code_prefixes: dict[str, tuple[str, int]] = field(
        default_factory=lambda: {
            "sector_economico_2_2pos": ("sector_economico_2", 2),
            "sector_economico_4_4_pos": ("sector_economico_4", 4),
        }
    )
    na_tokens: tuple[str, ...] = NA_TOKENS
    forbidden_columns: tuple[str, ...] = ("sector_economico_3",)
    ratio_prefix: str = "sbc_"
    # roles of single columns in reports
    flag: str = "ptpd"
    flag_values: tuple[str, ...] = ("0", "1", "no_disponible", "no_aplica")
    unavailable: str = "no_disponible"
    unlinked: str = "no_ligados_a_patron"
    entity: str = "cve_entidad"
    sex: str = "sexo"
    insured: str = "asegurados"
    non_workers: str = "no_trabajadores"
    jobs: str = "ta"
    jobs_paid: str = "ta_sal"
    payroll: str = "masa_sal_ta"
    main_ratio: str = "sbc_total"
    job_parts: tuple[str, ...] = ("tpu", "tpc", "teu", "tec")
    payroll_parts: tuple[str, ...] = (
        "masa_sal_tpu",
        "masa_sal_tpc",
        "masa_sal_teu",
        "masa_sal_tec",
    )
    fingerprint_counts: tuple[str, ...] = (
        "asegurados",
        "no_trabajadores",
        "ta",
        "ta_sal",
        "tpu",
        "tpc",
        "teu",
        "tec",
    )
    fingerprint_amounts: tuple[str, ...] = ("masa_sal_ta",)
    top_value_columns: tuple[str, ...] = (
        "periodo_informacion",
        "cve_entidad",
        "sexo",
        "rango_edad",
        "rango_ingreso_vsm",
        "rango_ingreso_uma",
        "sector_economico_1",
        "sector_economico_2",
        "sector_economico_4",
        "ptpd",
    )
    fact_ratios: tuple[str, ...] = (
        "sbc_total",
        "sbc_permanentes",
        "sbc_eventuales",
        "sbc_urbanos",
        "sbc_campo",
    )
    column_aliases: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"tamaño_patron": ("tamaño_patron", "tamaÃ±o_patron")}
    )
    legacy_dims: tuple[str, ...] = (
        "cve_entidad",
        "sexo",
        "rango_edad",
        "rango_uma",
        "sector_economico_1",
    )
    control_statuses: tuple[str, ...] = CONTROL_STATUSES

    @property
    def key_dims(self) -> tuple[str, ...]:
        return tuple(self.renamed_dims.get(d, d) for d in self.raw_dims)

    @property
    def keys(self) -> tuple[str, ...]:
        """The analytic key: period first, run metadata never part of it."""
        return (self.period, *self.key_dims)

    @property
    def raw_name(self) -> dict[str, str]:
        return {self.renamed_dims.get(d, d): d for d in self.raw_dims}

    @property
    def sums(self) -> tuple[str, ...]:
        return (*self.measures, *self.derived_sums)

    @property
    def required_in_files(self) -> tuple[str, ...]:
        dims = tuple(d for d in self.raw_dims if d not in self.optional_in_files)
        return (*dims, *self.measures)

    @property
    def cube_columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.sums, *self.ratios, *self.differences)

    @property
    def layout_columns(self) -> tuple[str, ...]:
        """Columns the layout audit expects in a published cube."""
        return (*self.keys, *self.measures, self.main_ratio)


DEFAULT_SPEC = CubeSpec()
