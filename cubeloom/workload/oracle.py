"""Building blocks of the oracle SQL: raw rows, normalised rows, cube and facts as CTEs."""

from __future__ import annotations

from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload.star_cube import RAW_SQL, quoted as q


def listed(names, fmt: str = "{}") -> str:
    return ", ".join(fmt.format(q(n)) for n in names)


def key_sql(key: str) -> str:
    """The value rules of one key column."""
    raw = q(SPEC.raw_name.get(key, key))
    if SPEC.raw_name.get(key) in SPEC.integer_code_dims:
        raw = rf"regexp_replace({raw}, '^([0-9]+)\.0$', '\1')"
    if key in SPEC.sector_dims:
        return rf"coalesce(regexp_replace(trim({raw}), '^(-?[0-9]+)\.0+$', '\1'), '')"
    if key in SPEC.label_dims:
        return f"coalesce(nullif(trim({raw}), ''), 'NA')"
    return f"nullif({raw}, '')"


NORM_SQL = (
    "SELECT "
    + ", ".join(f"{key_sql(k)} AS {q(k)}" for k in SPEC.keys)
    + ", "
    + listed(SPEC.measures)
    + ", "
    + ", ".join(f"{q(a)} + {q(b)} AS {q(n)}" for n, (a, b) in SPEC.derived_sums.items())
    + " FROM raw"
)
CUBE_SQL = (
    f"SELECT {listed(SPEC.keys)}, {listed(SPEC.sums, 'SUM({0}) AS {0}')} "
    f"FROM norm GROUP BY {listed(SPEC.keys)}"
)


def plus(names) -> str:
    return " + ".join(q(n) for n in names)


def ratio_sql(num, den) -> str:
    return f"CAST({plus(num)} AS DOUBLE) / NULLIF(CAST({plus(den)} AS DOUBLE), 0)"


RATIOS_SQL = ", ".join(f"{ratio_sql(n, d)} AS {q(r)}" for r, (n, d) in SPEC.ratios.items())
DIFFS_SQL = ", ".join(
    f"CAST(({plus(a)}) - ({plus(b)}) AS DOUBLE) AS {q(d)}"
    for d, (a, b) in SPEC.differences.items()
)
FACTS_SQL = (
    f"SELECT {q(SPEC.period)}, "
    + listed(SPEC.key_dims, "coalesce(nullif(trim({0}), ''), 'no_disponible') AS {0}")
    + ", "
    + listed(SPEC.sums, "coalesce({0}, 0) AS {0}")
    + " FROM cube"
)

CTES = {"raw": RAW_SQL, "norm": NORM_SQL, "cube": CUBE_SQL, "facts": FACTS_SQL}
NEEDS = {"raw": ("raw",), "norm": ("raw", "norm"), "cube": ("raw", "norm", "cube")}
NEEDS["facts"] = (*NEEDS["cube"], "facts")


def over(base: str, body: str, **more: str) -> str:
    """``body`` after the CTEs up to ``base`` and any further named ones, in order."""
    names = {name: CTES[name] for name in NEEDS[base]} | more
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in names.items()) + " " + body


def sums(names, fmt: str = "CAST(SUM({0}) AS DOUBLE) AS {0}") -> str:
    return listed(names, fmt)


def dbl(expr: str, alias: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {q(alias)}"


def big(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {q(alias)}"
