"""The cube aggregate: one shuffle on the analytic key, map-side combined by Spark."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeloom.functions.numbers import (
    exact_sum,
    exact_difference,
    from_exact,
    from_units,
    joined_units,
    number_column,
    rests,
    safe_ratio,
    total,
    units,
)
from cubeloom.functions.text import BETWEEN, joined_texts, parted_texts
from cubeloom.operators.normalize import derived_sums, measure_rows
from cubeloom.session import own_step
from cubeloom.spec import DEFAULT_SPEC, CubeSpec


def _parts(names: tuple[str, ...]) -> Column:
    return total([F.col(n) for n in names])


def _exact(plus: tuple[str, ...], minus: tuple[str, ...] = ()) -> Column:
    return exact_difference([F.col(n) for n in plus], [F.col(n) for n in minus])


def ratio_columns(spec: CubeSpec = DEFAULT_SPEC) -> dict[str, Column]:
    """Ratios of sums, never sums or means of ratios."""
    return {
        name: safe_ratio(_exact(num), _exact(den))
        for name, (num, den) in spec.ratios.items()
    }


def difference_columns(spec: CubeSpec = DEFAULT_SPEC) -> dict[str, Column]:
    """Gaps between a total and its parts; exact, so a match is 0 and not a rounding rest."""
    return {
        name: _exact(plus, minus)
        for name, (plus, minus) in spec.differences.items()
    }


SPREAD, SHARE, KEY = "_spread", "_share", "_key"
SHARE_ROWS = 250_000  # of a month, which one task sums beside other shares


def row_shares(rows: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> dict[str | None, int]:
    """In how many shares to deal each month, by its rows (the driver sees one row per month)."""
    counted = rows.groupBy(spec.period).agg(F.count("*").alias("n"))
    return {period: -(-n // SHARE_ROWS) for period, n in counted.collect()}


def _packed(rows: DataFrame, spec: CubeSpec) -> list[str]:
    """The keys that travel as one text: all texts but the period."""
    texts = {name for name, kind in rows.dtypes if kind == "string"}
    return [k for k in spec.keys if k in texts and k != spec.period]


def by_key(
    rows: DataFrame, spec: CubeSpec = DEFAULT_SPEC, shares: dict[str | None, int] | None = None
) -> DataFrame:
    """Numeric rows dealt by a hash of the key, which :func:`sum_to_cube` takes.

    Their texts travel as one, ``KEY``.  With ``shares`` a month is dealt in that many shares (not
    listed: one), so a task gets few months and its cube rows may be written by period without
    another shuffle.  The hashes are taken again behind the shuffle, as they are the part of a row
    that does not compress.
    """
    texts = _packed(rows, spec)
    packed = joined_texts([F.col(k) for k in texts]).alias(KEY)
    narrow = rows.select(packed, *[c for c in rows.columns if c not in texts])
    spread = F.xxhash64(KEY, *[k for k in spec.keys if k not in texts])
    if shares is None:
        return narrow.repartition(spread).withColumn(SPREAD, spread)
    period = F.col(spec.period)
    listed = sorted((month, n) for month, n in shares.items() if month is not None and n > 1)
    n = F.lit(1)
    if listed:
        n = F.coalesce(F.create_map(*[F.lit(v) for pair in listed for v in pair])[period], n)
    if shares.get(None, 1) > 1:
        n = F.when(period.isNull(), shares[None]).otherwise(n)
    share = F.xxhash64(period, F.pmod(spread, n.cast("bigint")))
    return narrow.repartition(share).withColumns({SPREAD: spread, SHARE: share})


def sum_to_cube(rows: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Group numeric rows by the key; null is a group, an all-null sum stays null.

    A key has hardly more rows than one, so a hash map would hold a wide buffer of sums for each
    row and end in spills.  The rows, which are narrow, are sorted instead, by the hash first.
    One aggregate is an empty text, as Spark sums sorted runs when one of them is a text.  The
    period is a key, so a filter on it reaches the rows before they are shuffled.
    """
    marked = rows.select("*", rests([F.col(c) for c in spec.sums]).alias("_rests"))
    own = [KEY, *[k for k in spec.keys if k in rows.columns and k != spec.period]]
    texts = [k for k in spec.keys if k not in rows.columns]
    share = [SHARE] if SHARE in rows.columns else []
    sums = marked.groupBy(SPREAD, *share, spec.period, *own).agg(
        F.first(F.lit("")).alias("_none"),
        *[F.sum(units(F.col(c))).alias(c) for c in spec.sums],
        *[F.sum(F.col("_rests")[i]).alias(n) for i, n in enumerate(_rest_names(spec).values())],
    )
    split = sums.withColumn("_texts", F.split(F.concat(KEY, "_none"), BETWEEN, -1))
    parted = zip(texts, parted_texts(F.col("_texts"), len(texts)))
    return _of_units(split.withColumns(dict(parted)) if texts else sums, spec)


def whole_cube(rows: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """What :func:`merge_cubes` makes of rows that have each key once, row by row."""
    marked = rows.select(*spec.keys, *spec.sums, rests([F.col(c) for c in spec.sums]).alias("_rests"))
    sums = marked.select(
        *spec.keys,
        *[units(F.col(c)).alias(c) for c in spec.sums],
        *[F.col("_rests")[i].alias(n) for i, n in enumerate(_rest_names(spec).values())],
    )
    return _of_units(own_step(sums), spec)


def _rest_names(spec: CubeSpec) -> dict[str, str]:
    return {c: f"_rest_{c}" for c in spec.sums}


def _of_units(sums: DataFrame, spec: CubeSpec) -> DataFrame:
    """The cube from the sums of units, under their own names, and of rests."""
    others = _rest_names(spec)

    def exact(plus: tuple[str, ...], minus: tuple[str, ...] = ()) -> Column:
        """Of BIGINT sums wherever nothing else was summed."""
        value, wide = _parts(plus), total([joined_units(F.col(n), F.col(others[n])) for n in plus])
        if minus:
            value = value - _parts(minus)
            wide = wide - total([joined_units(F.col(n), F.col(others[n])) for n in minus])
        plain = F.lit(True)
        for n in (*plus, *minus):
            plain = plain & F.col(others[n]).isNull()
        return F.when(plain, from_units(value)).otherwise(from_exact(wide))

    return sums.select(
        *spec.keys,
        *[exact((c,)).alias(c) for c in spec.sums],
        *[safe_ratio(exact(num), exact(den)).alias(name) for name, (num, den) in spec.ratios.items()],
        *[exact(plus, minus).alias(name) for name, (plus, minus) in spec.differences.items()],
    )


def cube_aggregate(
    raw: DataFrame, spec: CubeSpec = DEFAULT_SPEC, shares: dict[str | None, int] | None = None
) -> DataFrame:
    """Raw rows to the cube: normalise, cast, derive, group (null is a group), ratios, differences."""
    return sum_to_cube(derived_sums(by_key(measure_rows(raw, spec), spec, shares), spec), spec)


def merge_cubes(
    *cubes: DataFrame, spec: CubeSpec = DEFAULT_SPEC, shares: dict[str | None, int] | None = None
) -> DataFrame:
    """Partial cubes to one; columns are matched by name and ratios recomputed from the sums."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cubes)
    return sum_to_cube(by_key(union.select(*spec.keys, *spec.sums), spec, shares), spec)


def with_run_columns(cube: DataFrame, source_label: str, timestamp: str) -> DataFrame:
    return cube.withColumns({"fuente": F.lit(source_label), "timestamp": F.lit(timestamp)})


LEGACY_SUMS = {
    "total_asegurados": ("ta",),
    "masa_salarial_total": ("masa_sal_ta",),
    "trabajadores_permanentes": ("tpu", "tpc"),
    "trabajadores_eventuales": ("teu", "tec"),
    "masa_sal_permanentes": ("masa_sal_tpu", "masa_sal_tpc"),
    "masa_sal_eventuales": ("masa_sal_teu", "masa_sal_tec"),
}


def legacy_cube(
    raw: DataFrame, source_label: str, timestamp: str, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """The older 8-key cube: missing labels filled, missing numbers counted as 0."""
    numbers = sorted({m for parts in LEGACY_SUMS.values() for m in parts})
    rows = raw.select(
        F.lit(source_label).alias("fuente"),
        F.lit(timestamp).alias("timestamp"),
        F.col(spec.period),
        *[F.coalesce(F.col(d), F.lit(spec.unlinked)).alias(d) for d in spec.legacy_dims],
        *[F.coalesce(number_column(raw, m), F.lit(0.0)).alias(m) for m in numbers],
    )
    return rows.groupBy("fuente", "timestamp", spec.period, *spec.legacy_dims).agg(
        *[exact_sum(_parts(parts)).alias(name) for name, parts in LEGACY_SUMS.items()]
    )
