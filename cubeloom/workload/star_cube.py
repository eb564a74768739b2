"""The star-schema tables seen as raw rows of a period cube.

One row per lineitem; every cube column is an expression over lineitem and at
most one chain of dimension tables, looked up by left joins on their keys.  A
caller names the columns it needs and only their tables are read and joined.
The expressions are plain SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.operators.cube import cube_aggregate, row_shares
from cubeloom.spec import DEFAULT_SPEC, MEASURES, RAW_DIMS

# table -> (join keys of lineitem side, key of table, tables it hangs on)
LOOKUPS = {
    "orders": ("l_orderkey", "o_orderkey", ()),
    "customer": ("o_custkey", "c_custkey", ("orders",)),
    "nation": ("c_nationkey", "n_nationkey", ("orders", "customer")),
    "supplier": ("l_suppkey", "s_suppkey", ()),
    "part": ("l_partkey", "p_partkey", ()),
}

_PAID = "l_discount > 0"
_BRAND = "replace(p_brand, 'Brand#', '')"


def _split(place: int, value: str) -> str:
    return f"CASE WHEN l_orderkey % 4 = {place} THEN {value} ELSE 0 END"


DIMS = {
    "periodo_informacion": ("CAST(last_day(CAST(l_shipdate AS DATE)) AS STRING)", ()),
    "cve_delegacion": ("CAST(n_regionkey AS STRING)", ("nation",)),
    "cve_subdelegacion": ("CAST(s_nationkey AS STRING)", ("supplier",)),
    "cve_entidad": (
        "CAST(c_nationkey AS STRING) || CASE WHEN l_linenumber = 7 THEN '.0' ELSE '' END",
        ("customer",),
    ),
    "cve_municipio": (
        "CASE WHEN p_size = 50 THEN ' ' ELSE c_mktsegment END",
        ("customer", "part"),
    ),
    "tamaño_patron": (
        "CASE WHEN p_size <= 5 THEN '' WHEN p_size <= 20 THEN 'S1' "
        "WHEN p_size <= 35 THEN 'S2' ELSE 'S3' END",
        ("part",),
    ),
    "sexo": ("CASE WHEN l_linestatus = 'O' THEN '1' ELSE '2' END", ()),
    "rango_edad": (
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END",
        ("orders",),
    ),
    "rango_salarial": (
        "CASE WHEN l_discount <= 0.03 THEN 'W1' WHEN l_discount <= 0.07 THEN 'W2' ELSE 'W3' END",
        (),
    ),
    "rango_uma": (
        "CASE WHEN CAST(l_shipdate AS DATE) < DATE '1997-02-01' THEN NULL "
        "WHEN l_tax <= 0.04 THEN 'U1' ELSE 'U2' END",
        (),
    ),
    "sector_economico_1": (
        f"CAST(CAST({_BRAND} AS INT) % 9 AS STRING) "
        "|| CASE WHEN l_linenumber = 6 THEN '.0' ELSE '' END",
        ("part",),
    ),
    "sector_economico_2": (_BRAND, ("part",)),
    "sector_economico_4": (f"{_BRAND} || lpad(CAST(p_size AS STRING), 2, '0')", ("part",)),
    "ptpd": ("CASE WHEN l_returnflag = 'R' THEN '1' WHEN l_returnflag = 'A' THEN '0' END", ()),
}

NUMBERS = {
    "asegurados": "l_quantity + l_linenumber + CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END",
    "no_trabajadores": "l_linenumber",
    "ta": "l_quantity",
    "ta_sal": f"CASE WHEN {_PAID} THEN l_quantity ELSE 0 END",
    "tpu": f"CASE WHEN l_tax = 0 AND l_orderkey % 4 <> 0 THEN NULL "
    f"ELSE {_split(0, 'l_quantity')} END",
    "tpc": _split(1, "l_quantity"),
    "teu": f"CASE WHEN l_linenumber = 5 THEN 0 ELSE {_split(2, 'l_quantity')} END",
    "tec": _split(3, "l_quantity"),
}
for _place, _kind in enumerate(("tpu", "tpc", "teu", "tec")):
    NUMBERS[f"{_kind}_sal"] = _split(_place, f"CASE WHEN {_PAID} THEN l_quantity ELSE 0 END")
NUMBERS["masa_sal_ta"] = f"CASE WHEN {_PAID} THEN l_extendedprice ELSE 0 END"
for _place, _kind in enumerate(("tpu", "tpc", "teu", "tec")):
    _value = f"CASE WHEN {_PAID} THEN l_extendedprice ELSE 0 END"
    NUMBERS[f"masa_sal_{_kind}"] = _split(_place, _value)
NUMBERS["masa_sal_tec"] = (
    f"CASE WHEN l_linenumber = 7 THEN 0 ELSE {NUMBERS['masa_sal_tec']} END"
)

COLUMNS = ("periodo_informacion", *RAW_DIMS, *MEASURES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star_cube(
    spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None, by_month: bool = False
) -> DataFrame:
    """Raw cube rows with the wanted columns (default: all 14 dimensions and 17 measures).

    ``by_month`` clusters them by period, before the few joined columns become the many.
    """
    wanted = COLUMNS if columns is None else tuple(dict.fromkeys(columns))
    needed: list[str] = []
    for name in wanted:
        for lookup in DIMS[name][1] if name in DIMS else ():
            needed += [*LOOKUPS[lookup][2], lookup]
    lineitem = table(spark, sf_dir, "lineitem")
    if "orders" in needed:
        # the shuffle that a join with large orders needs anyhow, and which it then reuses
        lineitem = lineitem.repartition("l_orderkey")

    def join(rows: DataFrame, name: str) -> DataFrame:
        """A chain of dimensions is joined among itself first: the rows meet it once."""
        here, there, _ = LOOKUPS[name]
        further = [t for t in LOOKUPS if t in needed and LOOKUPS[t][2] == (*LOOKUPS[name][2], name)]
        looked_up = reduce(join, further, table(spark, sf_dir, name))
        return rows.join(looked_up, F.col(here) == F.col(there), "left")

    joined = reduce(join, [t for t in LOOKUPS if t in needed and not LOOKUPS[t][2]], lineitem)
    if by_month:
        month = F.expr(DIMS[DEFAULT_SPEC.period][0])
        joined = joined.withColumn("_month", month).hint("rebalance", F.col("_month"))
    return joined.select(
        *[
            F.expr(DIMS[c][0]).alias(c)
            if c in DIMS
            else F.expr(f"CAST({NUMBERS[c]} AS DOUBLE)").alias(c)
            for c in wanted
        ]
    )


def placed_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube with few months in each task, so it is written by period without a shuffle."""
    shares = row_shares(star_cube(spark, sf_dir, (DEFAULT_SPEC.period,)))
    return cube_aggregate(star_cube(spark, sf_dir), shares=shares)


def raw_columns_for(keys: tuple[str, ...], measures: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Raw names of key columns plus measures, as :func:`star_cube` wants them."""
    return (*[DEFAULT_SPEC.raw_name.get(k, k) for k in keys], *measures)


# ---------------------------------------------------------------- the same rows for the oracle


def quoted(name: str) -> str:
    return f'"{name}"'


STAR_FROM = "lineitem " + " ".join(
    f"LEFT JOIN {t} ON {here} = {there}" for t, (here, there, _) in LOOKUPS.items()
)
# measures are exact decimals on the oracle side
RAW_SQL = (
    "SELECT "
    + ", ".join(f"{sql} AS {quoted(c)}" for c, (sql, _) in DIMS.items())
    + ", "
    + ", ".join(f"CAST({sql} AS DECIMAL(18,2)) AS {quoted(c)}" for c, sql in NUMBERS.items())
    + f" FROM {STAR_FROM}"
)
