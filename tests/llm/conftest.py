import pytest

LONG = "word and more words, again and again; " * 6_000  # some 230,000 characters


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "A shared line of enough length.\nown line one is here now", "src1"),
        (2, "A shared line of enough length.\nown line two is here now", "src1"),
        (3, " a SHARED line of enough length.\t\nshort", None),
        (4, None, "src2"),
        (5, "", "src2"),
        (6, "   \n ", None),
        (7, LONG, "src1"),
        (7, LONG, "src1"),
        (8, LONG, "src2"),
        (None, "A shared line of enough length.", "src2"),
        (None, None, None),
        (9, "tie tie tie", "src1"),
        (10, "tie tie tie", "src1"),
        (10, "tie tie tie", "src1"),
        (11, "é漢字 Ünï \u3000 x\u00a0y 🙂", "src3"),
    ]
    names = "key row words n fp node piece passes blocks start rank cell label score kept_text".split()
    extra = ", ".join(f"{c} string" for c in names)
    return spark.createDataFrame(
        [(*r, *["x"] * len(names)) for r in rows], f"doc_id long, text string, source string, {extra}"
    )


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("false")
