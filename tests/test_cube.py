"""The cube aggregate on small fixtures, and its independence from partitioning."""

from pyspark.sql import functions as F

from cubeloom.operators import cube as C
from cubeloom.operators.history import multiset_difference
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload.star_cube import star_cube


def same(a, b):
    return multiset_difference(a, b).isEmpty() and multiset_difference(b, a).isEmpty()


def test_two_rows_of_one_key_merge(text_frame, raw_row):
    rows = [
        raw_row(ta="10", ta_sal="8", masa_sal_ta="800", tpu="10", tpc="0", teu="0", tec="0"),
        raw_row(ta="5", ta_sal="4", masa_sal_ta="400", tpu="5", tpc="0", teu="0", tec="0"),
    ]
    out = C.cube_aggregate(text_frame(rows)).collect()
    assert len(out) == 1
    assert (out[0].ta, out[0].sbc_total, out[0].diff_ta_componentes) == (15.0, 100.0, 0.0)
    assert tuple(out[0].asDict()) == SPEC.cube_columns


def test_null_is_a_group_and_an_all_null_sum_stays_null(text_frame, raw_row):
    rows = [raw_row(ptpd="<null>", ta="x"), raw_row(ptpd="<null>", ta=""), raw_row(ptpd="0")]
    out = {r.ptpd: r for r in C.cube_aggregate(text_frame(rows)).collect()}
    assert out[None].ta is None and out["0"].ta == 1.0
    assert out[None].diff_ta_componentes is None


def test_derived_sum_needs_both_parts_in_the_same_row(text_frame, raw_row):
    rows = [raw_row(tpu="2", tpc="<null>"), raw_row(tpu="3", tpc="4")]
    out = C.cube_aggregate(text_frame(rows)).first()
    assert (out.tpu, out.tpc, out.puestos_permanentes) == (5.0, 4.0, 7.0)


def test_zero_denominator_gives_null(text_frame, raw_row):
    zeros = {c: "0" for c in ("ta_sal", "tpu_sal", "tpc_sal", "teu_sal", "tec_sal")}
    out = C.cube_aggregate(text_frame([raw_row(**zeros)])).first()
    assert all(out[r] is None for r in SPEC.ratios)


def test_codes_keep_leading_zeros(text_frame, raw_row):
    row = raw_row(sector_economico_2="05", sector_economico_4="0501", cve_entidad="9.0")
    out = C.cube_aggregate(text_frame([row])).first()
    assert (out.sector_economico_2, out.sector_economico_4, out.cve_entidad) == ("05", "0501", "9")


def test_merge_of_any_split_equals_the_whole(spark, sf_dir):
    raw = star_cube(spark, sf_dir)
    whole = C.cube_aggregate(raw)
    parts = [C.cube_aggregate(raw.filter(F.col("ta") % 4 == i)) for i in range(4)]
    assert same(whole, C.merge_cubes(*parts))


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    raw = star_cube(spark, sf_dir)
    one = C.cube_aggregate(raw.coalesce(1)).collect()
    many = C.cube_aggregate(raw.repartition(64)).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_merge_accepts_partials_without_newer_columns(text_frame, raw_row):
    new = C.cube_aggregate(text_frame([raw_row(ptpd="<null>")]))
    old = C.cube_aggregate(text_frame([raw_row(ptpd="<null>")])).drop("ptpd")
    out = C.merge_cubes(new, old).collect()
    assert len(out) == 1 and out[0].ta == 2.0
