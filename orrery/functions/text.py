"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as Unicode defines it; the regex class `\s` alone is ASCII-only in Java and RE2.
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# The same characters as a set, for trimming.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(x: Column) -> Column:
    """Remove leading and trailing whitespace, including the non-ASCII kinds."""
    return F.btrim(x, F.lit(SPACE_CHARS))


def preview(x: Column, width: int) -> Column:
    """The first `width` characters followed by three dots."""
    return F.concat(F.substring(x, 1, width), F.lit("..."))


def pad_cell(x: Column, width: int) -> Column:
    """Pad on the right up to `width`; longer values stay whole."""
    return F.rpad(x, F.greatest(F.length(x), F.lit(width)), F.lit(" "))


def number_text(x: Column) -> Column:
    """Decimal text of a double (digits as Java prints them): plain from 1e-4 up to 1e16, else with a
    two-digit exponent. Spark's own cast leaves plain notation at 1e-3 and 1e7."""
    raw = x.cast("double").cast("string")
    parts = r"^(-?)(\d)\.(\d+)E(-?)(\d+)$"

    def part(i: int) -> Column:
        return F.regexp_extract(raw, parts, i)

    sign, lead, minus = part(1), part(2), part(4)
    frac = F.when(part(3) == "0", F.lit("")).otherwise(part(3))
    power = F.when(part(5) == "", F.lit(0)).otherwise(part(5).try_cast("int"))
    digits = F.concat(lead, frac)
    large = F.concat(
        sign,
        F.substring(F.rpad(digits, F.greatest(F.length(digits), power + 1), F.lit("0")), F.lit(1), power + 1),
        F.lit("."),
        F.when(F.length(digits) > power + 1, F.substring(digits, power + 2, F.lit(40))).otherwise(F.lit("0")),
    )
    tail = F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac))
    exponent = F.concat(
        sign, lead, tail, F.lit("e"), F.when(minus == "-", F.lit("-")).otherwise(F.lit("+")),
        F.lpad(power.cast("string"), F.greatest(F.lit(2), F.length(power.cast("string"))), F.lit("0")),
    )
    return (
        F.when(raw == "NaN", F.lit("nan"))
        .when(raw == "Infinity", F.lit("inf"))
        .when(raw == "-Infinity", F.lit("-inf"))
        .when(~raw.contains("E"), raw)
        .when((minus == "") & (power < 16), large)
        .when((minus == "-") & (power == 4), F.concat(sign, F.lit("0.000"), digits))
        .otherwise(exponent)
    )


def cell_text(x: Column, dtype: str) -> Column:
    """Display text of a value; missing values read `None`."""
    shown = number_text(x) if dtype in ("double", "float") else x.cast("string")
    return F.coalesce(shown, F.lit("None"))


def iso_time(ts: Column) -> Column:
    """ISO date and time; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def clean_file_name(name: Column) -> Column:
    """Replace every character that is not a letter, digit, `-` or `_` by `_`."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")
