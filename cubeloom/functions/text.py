"""Text rules for dimension values, all as JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode blank below U+3001, which is what Python's str.strip removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

DEFENSIVE_DECIMAL = r"^([0-9]+)\.0$"
DECIMAL_LOOKING_INTEGER = r"^(-?[0-9]+)\.0+$"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def has_odd_edge(col: Column) -> Column:
    """Whether the first or last character is not printable ASCII: a cheap test, true for all
    blanks.  Rules use it to leave clean values, nearly all of them, untouched."""
    return ~(col.between("!", "~") & F.substring(col, -1, 1).between("!", "~"))


def blank_to_null(col: Column) -> Column:
    """Exactly '' becomes null; blanks of any other width stay."""
    return F.when(col != "", col)


def tokens_to_null(col: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~col.isin(*tokens), col)


def blank_to_label(col: Column, label: str) -> Column:
    stripped = strip(col)
    labelled = F.coalesce(F.when(stripped != "", stripped), F.lit(label))
    return F.when(has_odd_edge(col), labelled).otherwise(F.coalesce(col, F.lit(label)))


def clean_sector_code(col: Column) -> Column:
    """Trimmed code; a decimal-looking integer loses its zeros, null becomes ''."""
    suspect = has_odd_edge(col) | (col.endswith("0") & col.contains("."))
    cleaned = F.regexp_replace(strip(col), DECIMAL_LOOKING_INTEGER, "$1")
    return F.when(suspect, cleaned).otherwise(F.coalesce(col, F.lit("")))


def has_defensive_decimal(col: Column) -> Column:
    return col.rlike(DEFENSIVE_DECIMAL)


def strip_defensive_decimal(col: Column) -> Column:
    repaired = F.regexp_replace(col, DEFENSIVE_DECIMAL, "$1")
    return F.when(col.endswith(".0"), repaired).otherwise(col)


MARK, BETWEEN = "\x1e", "\x1f"  # in and between the parts of a joined text


def joined_texts(columns: list[Column]) -> Column:
    """Texts as one that tells them apart, null and '' too; :func:`parted_texts` gives them back.

    A row with one text is half as wide in a shuffle as one with a dozen short texts.
    """

    def part(col: Column) -> Column:
        marked = F.replace(F.replace(col, F.lit(MARK), F.lit(f"{MARK}e")), F.lit(BETWEEN), F.lit(f"{MARK}u"))
        own = F.when(col.contains(MARK) | col.contains(BETWEEN), marked).otherwise(col)
        return F.coalesce(own, F.lit(f"{MARK}n"))

    return F.concat_ws(BETWEEN, *[part(c) for c in columns])


def parted_texts(parts: Column, n: int) -> list[Column]:
    """The ``n`` texts of a joined text that was split at ``BETWEEN``."""

    def text(col: Column) -> Column:
        plain = F.replace(F.replace(col, F.lit(f"{MARK}u"), F.lit(BETWEEN)), F.lit(f"{MARK}e"), F.lit(MARK))
        return F.when(~col.contains(MARK), col).when(col != f"{MARK}n", plain)

    return [text(F.get(parts, F.lit(i))) for i in range(n)]


def comparable_text(col: Column) -> Column:
    """Upper-case trimmed text; '', 'NAN' and 'NONE' count as missing."""
    return tokens_to_null(F.upper(strip(col)), ("", "NAN", "NONE"))
