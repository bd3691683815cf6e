"""Column functions: typing, cleaning and classifying single values.

All are built-in expressions. Text that cannot be parsed becomes null and never
raises, also in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode blanks, as a character list for trimming and as a regex class body.
# The class reads the same in Java and in RE2.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_CLASS = r"\t-\r\x1c-\x20\x{85}\p{Z}"

NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def nonblank(col: Column) -> Column:
    """Null where the text is null or only blanks; otherwise the text unchanged."""
    return F.when(trimmed(col) != "", col)


def norm_key(col: Column) -> Column:
    """Grouping key: trimmed, lower case, blank to null."""
    return F.nullif(F.lower(trimmed(col)), F.lit(""))


def num(col: Column) -> Column:
    """Text to double; anything but a plain finite number is null.

    The pattern keeps out what a cast would accept in addition, such as '5d' or 'NaN'.
    """
    text = trimmed(col)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def whole(col: Column) -> Column:
    """Text to int by way of double, cutting the fraction: '2015.0' is 2015."""
    return num(col).try_cast("int")


def first_nonblank(*cols: Column) -> Column:
    """First of ``cols`` that is neither null nor blank."""
    return F.coalesce(*[nonblank(col) for col in cols])


def days_or_default(col: Column, default: int | None = None) -> Column:
    """Days on market as int; blank becomes ``default``, unparseable stays null."""
    if default is None:
        return whole(col)
    return F.when(nonblank(col).isNull(), F.lit(default)).otherwise(whole(col))


# Labels and cuts of the price bands.
BAND_LABELS = ("basso", "medio", "alto")
BAND_CUTS = (20_000.0, 50_000.0)
ALT_BAND_CUTS = (15_000.0, 35_000.0)


def price_band(
    price: Column,
    cuts: Sequence[float] = BAND_CUTS,
    labels: Sequence[str] = BAND_LABELS,
    closed: str = "right",
) -> Column:
    """Label of the band ``price`` falls into.

    The lowest band always excludes its cut. ``closed='right'`` puts a price equal
    to a higher cut into the band below it, ``closed='left'`` into the one above.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cuts")
    if closed not in ("right", "left"):
        raise ValueError(f"closed must be 'right' or 'left', not {closed!r}")
    out = F.when(price < F.lit(float(cuts[0])), labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        limit = F.lit(float(cut))
        out = out.when(price <= limit if closed == "right" else price < limit, label)
    return out.when(price.isNotNull(), labels[-1])


def strip_unit(col: Column, unit: str) -> Column:
    """'35.1 in' to 35.1; the placeholder '--' and bad text to null."""
    return num(F.replace(F.nullif(col, F.lit("--")), F.lit(unit), F.lit("")))


def to_bool(col: Column) -> Column:
    """The text 'True' is true; everything else, null included, is false."""
    return F.coalesce(col == "True", F.lit(False))


def parse_list(col: Column) -> Column:
    """Text of a list literal to array<string>; blank or bad text to an empty array.

    A bare None is a null element.
    """
    # Quoted runs and what lies between, each as a whole: a None in quotes is text.
    parts = F.regexp_extract_all(col, F.lit(r"""'[^']*+'|"[^"]*+"|[^'"]++|['"]"""), F.lit(0))
    bare = F.transform(
        parts,
        lambda x: F.when(x.startswith("'") | x.startswith('"'), x).otherwise(
            F.regexp_replace(x, r"\bNone\b", "null")
        ),
    )
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    items = F.from_json(F.array_join(bare, ""), "array<string>", options)
    return F.coalesce(items, F.array().cast("array<string>"))


def first_number(col: Column, dtype: str = "double") -> Column:
    """First run of digits in the text."""
    return F.nullif(F.regexp_extract(col, r"(\d+)", 1), F.lit("")).try_cast(dtype)


def rpm(col: Column) -> Column:
    """Revolutions from '177 hp @ 5,750 RPM'."""
    digits = F.regexp_extract(col, r"@\s*(\d[\d,]*)\s*RPM", 1)
    return F.nullif(F.replace(digits, F.lit(","), F.lit("")), F.lit("")).try_cast("double")


def to_date_lenient(col: Column) -> Column:
    """ISO text to date; other text is null."""
    return trimmed(col).try_cast("date")


def strip_tags(col: Column) -> Column:
    """Delete [!@@ ... @@!] tags within a line and trim; null becomes ''."""
    return trimmed(F.regexp_replace(F.coalesce(col, F.lit("")), r"(?d)\[!@@.*?@@!\]", ""))


def two_decimals(col: Column) -> Column:
    """Fixed two decimals, no grouping, rounding the exact binary value half to even."""
    return F.call_function("format_number", col, F.lit("0.00"))


def quoted(text: Column) -> Column:
    """Text between single quotes, or double ones where it holds a single quote itself."""
    apostrophe = text.contains("'") & ~text.contains('"')
    mark = F.when(apostrophe, '"').otherwise("'")
    return F.concat(mark, text, mark)


def bracketed(col: Column, quote: bool = False) -> Column:
    """Array as '[a, b]', its elements quoted on request."""
    parts = F.transform(col, lambda x: quoted(x) if quote else x.cast("string"))
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def rate(amount: Column, seconds: Column) -> Column:
    """Amount per second; 0 where no time passed."""
    return F.when(seconds > 0, amount / seconds).otherwise(F.lit(0.0))
