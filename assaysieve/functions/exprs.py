"""Column expressions shared by the operators. All of them stay in the JVM and are safe under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaysieve.functions.vocabulary import BLANK_IDENTIFIERS, IMAGE_PREFIX, IMAGE_SUFFIX

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: str | Column) -> Column:
    """A column by its exact name (names may hold dots or slashes), or the column itself."""
    return c if isinstance(c, Column) else F.col("`" + c.replace("`", "``") + "`")


def strip(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def lookup_key(c: str | Column) -> Column:
    """Normalised text used to match entity names."""
    return F.lower(strip(c))


def substitute(c: str | Column, mapping: dict[str, str]) -> Column:
    """Replace a whole value by its entry in a small fixed mapping."""
    if not mapping:
        return col(c)
    pairs = [F.lit(text) for item in mapping.items() for text in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), col(c))


def finite_or_null(c: str | Column) -> Column:
    """NaN becomes NULL, the only notion of missing used downstream."""
    return F.when(~F.isnan(col(c)), col(c))


def half_even(c: str | Column, digits: int) -> Column:
    """Scale, round to the nearest integer (ties to even), scale back."""
    step = F.lit(float(10**digits))
    return F.rint(col(c) * step) / step


def clip(c: str | Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL, which greatest/least alone would not keep."""
    return F.when(col(c).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col(c))))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is zero or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def number_or(c: str | Column, default: float | int, as_type: str = "double") -> Column:
    """Text to number with a default for missing or malformed text."""
    return F.coalesce(col(c).cast("string").try_cast(as_type), F.lit(default).cast(as_type))


def has_identifier(c: str | Column) -> Column:
    return ~F.coalesce(strip(c), F.lit("")).isin(*BLANK_IDENTIFIERS)


def path_quote(c: str | Column) -> Column:
    """Percent-encode for a URL path: space is %20; slash and tilde stay; star is encoded."""
    encoded = F.url_encode(col(c))
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return encoded


def image_link(identifier: str | Column, prefix: str = IMAGE_PREFIX, suffix: str = IMAGE_SUFFIX) -> Column:
    """Link to a rendered picture, NULL without a usable identifier."""
    text = strip(identifier)
    return F.when(has_identifier(identifier), F.concat(F.lit(prefix), path_quote(text), F.lit(suffix)))


def unit_scale(c: str | Column, low: Column | float | None, high: Column | float | None, floor: float = 0.001) -> Column:
    """Min-max scaled value clipped to [floor, 1]; 1 when the bounds coincide or are missing."""
    lo, hi = (b if isinstance(b, Column) else F.lit(b).cast("double") for b in (low, high))
    return F.when(hi > lo, clip(safe_ratio(col(c) - lo, hi - lo), floor, 1.0)).otherwise(F.lit(1.0))


def row_geometric_mean(values: list[Column]) -> Column:
    """Geometric mean across columns of one row, skipping NULLs; NULL if all are NULL."""
    logs = [F.ln(v) for v in values]
    total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in logs])
    present = reduce(add, [F.when(v.isNotNull(), 1).otherwise(0) for v in logs])
    return F.exp(safe_ratio(total, present))


def three_classes(values: list[Column], high: float = 50.0, low: float = 20.0) -> Column:
    """Class by thresholds: every value above high, any value above low, or neither."""
    every = reduce(lambda a, b: a & b, [F.coalesce(v > high, F.lit(False)) for v in values])
    some = reduce(lambda a, b: a | b, [F.coalesce(v > low, F.lit(False)) for v in values])
    return (
        F.when(every, F.lit("Highly Compatible"))
        .when(some, F.lit("Moderately Compatible"))
        .otherwise(F.lit("Incompatible"))
    )


def percent_text(c: str | Column) -> Column:
    """87.25 -> "87.2%": text form used only when writing."""
    return F.format_string("%.1f%%", half_even(c, 1))


def percent_value(c: str | Column) -> Column:
    return F.replace(col(c), F.lit("%"), F.lit("")).try_cast("double")


def heavy_atoms(c: str | Column) -> Column:
    """Non-hydrogen atoms in a SMILES string: bracket atoms except [H], or organic-subset symbols."""
    bracket_h = r"\[[0-9]*H[+-]?[0-9]*\]"
    atom = r"\[[^\]]+\]|Cl|Br|[BCNOPSFIbcnops]"
    return F.regexp_count(col(c), F.lit(atom)) - F.regexp_count(col(c), F.lit(bracket_h))


def local_stamp(zone: str = "Asia/Kolkata", suffix: str = " IST") -> Column:
    moment = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
    return F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm"), F.lit(suffix))


def title_case(c: str | Column) -> Column:
    """Every run of letters with its first letter in upper case and the others in lower case, underscores as blanks."""
    text = F.replace(col(c), F.lit("_"), F.lit(" "))
    # A blank after each other character makes initcap treat it as a border; the mark takes the blanks out again.
    marked = F.regexp_replace(text, r"(?<=[^\p{L} ])(?=\p{L})", "\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def title_text(name: str) -> str:
    """Heading made from a column name."""
    return name.replace("_", " ").title()
