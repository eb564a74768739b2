"""Value rules, with the traps that pandas, ANSI SQL and Spark treat differently."""

import math

import pytest
from pyspark.sql import functions as F

from cubeloom.functions import text
from cubeloom.functions.numbers import exact_sum, parse_number, safe_ratio, unit_sum
from cubeloom.operators import normalize as N
from cubeloom.operators.cube import cube_aggregate
from cubeloom.spec import DEFAULT_SPEC as SPEC


def apply(spark, rule, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_blank_to_null_is_exact(spark):
    assert apply(spark, text.blank_to_null, "", " ", "a", None) == [None, " ", "a", None]


def test_blank_to_label_trims_every_kind_of_blank(spark):
    rule = lambda c: text.blank_to_label(c, "NA")
    values = ("", " ", None, " x ", "\ty\n", "z", " ", " w", "ñ", "a b")
    assert apply(spark, rule, *values) == ["NA", "NA", "NA", "x", "y", "z", "NA", "w", "ñ", "a b"]


def test_sector_codes(spark):
    values = (" 2.0 ", "1.5", None, "", "NA", "-3.00", "05", "0501", "2.0x", "5.0", "10", "1.50")
    assert apply(spark, text.clean_sector_code, *values) == [
        "2", "1.5", "", "", "NA", "-3", "05", "0501", "2.0x", "5", "10", "1.50",
    ]


def test_defensive_decimal_leaves_other_texts(spark):
    values = ("9.0", "9.00", "-9.0", "9", " 9.0", None, ".0", "x.0")
    assert apply(spark, text.strip_defensive_decimal, *values) == [
        "9", "9.00", "-9.0", "9", " 9.0", None, ".0", "x.0",
    ]


def test_repair_skips_columns_that_are_not_codes(text_frame, raw_row):
    df = text_frame([raw_row(cve_municipio="9.0", cve_entidad="9.0", sector_economico_1="<null>")])
    row = N.repair_integer_codes(df).first()
    assert (row.cve_municipio, row.cve_entidad, row.sector_economico_1) == ("9.0", "9", None)
    counts = N.integer_code_repair_counts(df.drop("sector_economico_4")).first()
    assert (counts.cve_entidad, counts.cve_delegacion, counts.sector_economico_4) == (1, 0, 0)


def test_key_expressions_equal_the_rules_one_after_the_other(spark, text_frame, raw_row):
    odd = ("", " ", "<null>", "1.0", " 1.0 ", "01", "A", "2.00", "NA", "x\t", "-1.0", " ")
    df = text_frame([raw_row(**{d: v for d in SPEC.raw_dims}) for v in odd])
    step = N.label_dims(N.normalize_dims(N.repair_integer_codes(df))).select(*SPEC.keys)
    once = df.select(*[N.key_expression(df, k) for k in SPEC.keys])
    assert sorted(map(str, step.collect())) == sorted(map(str, once.collect()))


def test_numbers_are_guarded(spark):
    values = ("12", " 12.5 ", "12d", "NaN", "inf", "1e3", "", None, "x", "-.5", "1,0", "0x1p3")
    got = apply(spark, parse_number, *values)
    assert got == [12.0, 12.5, None, None, None, 1000.0, None, None, None, -0.5, None, None]


def test_default_tokens_are_missing_and_can_be_kept(spark):
    tokens = lambda c: text.tokens_to_null(c, SPEC.na_tokens)
    assert apply(spark, tokens, "NA", "null", "None", "N/A", "ND", "") == [
        None, None, None, None, "ND", None,
    ]
    kept = lambda c: text.tokens_to_null(c, ("",))
    assert apply(spark, kept, "NA", "") == ["NA", None]


def test_income_ranges_stay_apart_and_absent_columns_are_null(text_frame, raw_row):
    df = text_frame([raw_row(rango_salarial="W1", rango_uma=None, ptpd=None)])
    row = N.normalize_dims(df).first()
    assert (row.rango_ingreso_vsm, row.rango_ingreso_uma, row.ptpd) == ("W1", None, None)
    assert "rango_salarial" not in row.asDict()
    full = N.add_missing_dims(df)
    assert set(SPEC.raw_dims) <= set(full.columns) and full.first().ptpd is None


def test_missing_measures_fail_while_the_plan_is_built(text_frame, raw_row):
    df = text_frame([raw_row(ta=None, tec=None)])
    assert N.missing_measures(df) == ["ta", "tec"]
    with pytest.raises(N.MissingColumnsError, match="ta, tec"):
        N.cube_rows(df)


def test_ratio_is_null_for_zero_and_missing_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    assert [r.x for r in df.select(safe_ratio(F.col("a"), F.col("b")).alias("x")).collect()] == [
        None, None, 2.0,
    ]


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9] * 200
    up = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    down = spark.createDataFrame([(v,) for v in reversed(values)], "v double").coalesce(1)
    total = [d.agg(exact_sum(F.col("v")).alias("s")).first().s for d in (up, down)]
    assert total == [120.0, 120.0]


def total_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_sum(F.col("v"))).first()[0]


def test_sums_have_no_largest_total_and_no_smallest_value(spark):
    assert total_of(spark, [9e14, 9e14]) == 1.8e15
    assert total_of(spark, [1e12] * 2_000) == 2e15
    assert total_of(spark, [1e15, 0.25, -1e15]) == 0.25
    assert total_of(spark, [0.00004] * 3) == 0.00012
    assert total_of(spark, [1e6 + 0.123456, 0.1, None]) == 1000000.223456
    assert total_of(spark, [None]) is None
    assert total_of(spark, [1.0, float("inf")]) == float("inf")
    assert math.isnan(total_of(spark, [1.0, float("nan")]))


def test_cube_sums_keep_small_amounts(spark, text_frame, raw_row):
    cube = cube_aggregate(text_frame([raw_row(ta="0.00004"), raw_row(ta="0.00004"), raw_row(ta="1e12")]))
    row = cube.first()
    assert row.ta == 1e12 + 0.00008 and row.asegurados == 3.0


def test_a_measure_that_is_not_finite_ends_a_cube_with_an_error(spark):
    df = spark.createDataFrame([(float("inf"),)], "v double")
    with pytest.raises(Exception, match="not finite"):
        df.agg(unit_sum(F.col("v"))).collect()


def test_staging_projection(text_frame, raw_row):
    names = {"rango_ingreso_vsm": " ", "rango_ingreso_uma": "U1", "sbc_total": "1,234.5"}
    row = raw_row(ta="1,000", sexo=" 2 ", **names)
    row["tamaÃ±o_patron"] = row.pop("tamaño_patron")
    out = N.staging_projection(text_frame([row]), "r1").first()
    assert (out.run_id, out.ta, out.sexo, out.rango_ingreso_vsm) == ("r1", 1000.0, "2", None)
    assert (out["tamaño_patron"], out.sbc_total, out.source_url) == ("1", 1234.5, None)
    assert len(out) == 49


def test_fact_defaults(spark):
    df = spark.createDataFrame(
        [("2025-01-31", " ", None, None, None)],
        "periodo_informacion string, sexo string, ptpd string, ta double, sbc_total double",
    )
    row = N.fact_defaults(df).first()
    assert tuple(row) == ("2025-01-31", "no_disponible", "no_disponible", 0.0, None)


def test_recode_and_annotate(spark):
    df = spark.createDataFrame([("a",), ("b",)], "sexo string")
    df = N.annotate(
        N.recode(df, "sexo", {"a": "89"}), "c", [(F.lit(True), "first"), (F.col("sexo") == "89", "x")]
    )
    assert sorted(map(tuple, df.collect())) == [("89", "x"), ("b", "first")]
