"""Column expressions shared by the operators. All run inside codegen; no UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text strip removes at both ends
WHITESPACE = (" \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Text accepted as a number
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text --------------------------------------------------------------------

def strip(c: Column | str) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    text = strip(col(c).cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_whole(c: Column | str) -> Column:
    """Text to int, truncated toward zero; NULL and unparseable become 0."""
    return F.coalesce(to_number(c).try_cast("int"), F.lit(0))


def contains_ci(c: Column | str, needle: str) -> Column:
    return F.contains(F.lower(col(c)), F.lit(needle.lower()))


def yes_no(c: Column | str) -> Column:
    """0/1 in any spelling to No/Yes; other text becomes NULL."""
    text = strip(col(c).cast("string"))
    return (F.when(text.isin("0", "0.0", "No"), "No")
            .when(text.isin("1", "1.0", "Yes"), "Yes"))


def feature_name(c: Column | str) -> Column:
    """Blanks to underscores, parentheses dropped."""
    return F.translate(col(c), " ()", "_")


def percent_text(share: Column, places: int = 1) -> Column:
    return F.format_string(f"%.{places}f%%", share * 100)


# -- numbers -----------------------------------------------------------------

def round_even(c: Column | str, places: int) -> Column:
    """Round half to even on the binary value."""
    step = float(10 ** places)
    return F.rint(col(c) * step) / step


def round_up(c: Column | str, places: int) -> Column:
    """Round half up on the binary value."""
    step = float(10 ** places)
    return F.floor(col(c) * step + 0.5) / step


def ratio(a: Column, b: Column) -> Column:
    """Double division; NULL where the denominator is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def pct(a: Column, b: Column) -> Column:
    return 100.0 * a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def clip(c: Column, lo: float, hi: float) -> Column:
    """Bounds that keep NULL (least/greatest alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def minmax_score(c: Column, lo: float, hi: float, higher_is_better: bool) -> Column:
    scaled = clip((c - lo) / (hi - lo), 0.0, 1.0)
    return scaled if higher_is_better else 1.0 - scaled


def mean_skip_null(parts: list[Column]) -> Column:
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])
    present = reduce(lambda a, b: a + b, [p.isNotNull().cast("int") for p in parts])
    return total / F.nullif(present.cast("double"), F.lit(0.0))


def logistic(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(z, -35.0, 35.0)))


# -- flags and bands -----------------------------------------------------------

def flag(condition: Column) -> Column:
    """0/1 int; unknown counts as 0."""
    return F.when(condition, 1).otherwise(0)


def count_yes(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [flag(F.col(c) == "Yes") for c in columns])


def inclusive_bucket(c: Column | str, buckets: list[tuple[int, int, str]]) -> Column:
    """Inclusive ranges; above the last goes to the last label, anything else to the first."""
    value, out = col(c), F.lit(None)
    out = F.when(value > buckets[-1][1], buckets[-1][2])
    for lo, hi, label in buckets:
        out = out.when(value.between(lo, hi), label)
    return out.otherwise(buckets[0][2])


def right_closed_band(c: Column | str, edges: list[tuple[float, str]], lowest: float) -> Column:
    """(previous edge, edge] -> label; NULL outside."""
    value = col(c)
    out = F.when(value <= lowest, F.lit(None).cast("string"))
    for edge, label in edges:
        out = out.when(value <= edge, label)
    return out


def left_closed_band(c: Column | str, bands: list[tuple[float, float, str]]) -> Column:
    """[lo, hi) -> label; outside every band goes to the last label."""
    value, out = col(c), None
    for lo, hi, label in bands:
        hit = (value >= lo) & (value < hi)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.when(value.isNotNull(), bands[-1][2]))


def order_index(c: Column | str, labels: list[str]) -> Column:
    """1..n position of a label in a business order."""
    out = None
    for i, label in enumerate(labels, start=1):
        hit = col(c) == label
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


# -- sums that do not depend on row order -----------------------------------------

def units(c: Column | str, places: int) -> Column:
    """Whole units of the last declared decimal place."""
    return F.rint(col(c) * float(10 ** places)).cast("bigint")


def exact_sum(c: Column | str, places: int) -> Column:
    """Sum over whole units, so retries and partitioning cannot change the last digits."""
    return F.sum(units(c, places)).cast("double") / float(10 ** places)


def exact_avg(c: Column | str, places: int) -> Column:
    value = units(c, places)
    return (F.sum(value).cast("double")
            / F.nullif((F.count(value) * (10 ** places)).cast("double"), F.lit(0.0)))


# readings are summed as decimals of this many places, finer than any feed states them
READING = "decimal(29,9)"


def read_sum(c: Column | str) -> Column:
    """Sum of readings as they were read, in an order that cannot matter."""
    return F.sum(col(c).cast(READING)).cast("double")


def read_avg(c: Column | str) -> Column:
    return read_sum(c) / F.nullif(F.count(col(c)).cast("double"), F.lit(0.0))


# -- months ------------------------------------------------------------------------

def month_ordinal(d: Column | str) -> Column:
    return F.year(col(d)) * 12 + F.month(col(d))


def month_text(ordinal: Column) -> Column:
    """'YYYY-MM' of year*12+month."""
    year = F.floor((ordinal - 1) / 12).cast("int")
    month = (ordinal - 1) % 12 + 1
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(month.cast("string"), 2, "0"))


def text_ordinal(month: Column | str) -> Column:
    """year*12+month of 'YYYY-MM'."""
    m = col(month)
    return (F.substring(m, 1, 4).cast("int") * 12 + F.substring(m, 6, 2).cast("int"))
