"""Column expressions for cleaning, conversion and rating arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw salary texts that mean "not reported".
MISSING_SALARIES = ("NA", " ", "0")

# Payments per year for each reported period.
PERIOD_FACTORS = {"Weekly": 52, "Monthly": 12, "Yearly": 1}

# Bounds of a 32-bit integer.
INT_MIN = -2147483648
INT_MAX = 2147483647

# Every character up to and including the space, which Java's trim() removes.
_BLANKS = "".join(chr(code) for code in range(33))


def java_trim(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def valid_salary(raw: Column) -> Column:
    """True for a reported salary; compared on the untrimmed text. An empty field isn't null:
    it counts as reported and malformed."""
    return F.coalesce(~raw.isin(*MISSING_SALARIES), F.lit(True))


def clean_country(raw: Column) -> Column:
    """Trim first, then remove quotes."""
    return F.translate(java_trim(raw), '"', "")


def clean_salary(raw: Column) -> Column:
    """Salary as double without quotes and thousands separators; null when malformed."""
    return F.translate(java_trim(raw), '",', "").try_cast("double")


def annualise(salary: Column, period: Column) -> Column:
    """Yearly amount; a missing period counts as yearly, an unknown one gives null."""
    name = F.replace(java_trim(period), F.lit("NA"), F.lit("Yearly"))
    factor = F.lit(None).cast("int")
    for label, times in PERIOD_FACTORS.items():
        factor = F.when(name == label, F.lit(times)).otherwise(factor)
    return salary * factor


def clamp(c: Column, lo: float = 0.0, hi: float = 5.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def saturating_int(c: Column) -> Column:
    """Truncate a double to int, holding at the 32-bit bounds instead of failing."""
    return (
        F.when(F.isnan(c), F.lit(0))
        .when(c >= INT_MAX, F.lit(INT_MAX))
        .when(c <= INT_MIN, F.lit(INT_MIN))
        .otherwise(c)
        .cast("int")
    )


def two_decimals(c: Column) -> Column:
    """Text with two decimals, half-even, no grouping and no leading zero."""
    return F.call_function("format_number", c, F.lit("#.00"))


def error_bucket(abs_err: Column) -> Column:
    """0..4 for [0,1) [1,2) [2,3) [3,4) [4,inf)."""
    return F.least(F.floor(abs_err), F.lit(4)).cast("int")


def not_self_pair(u: Column, v: Column) -> Column:
    return u != v


def contains_all(basket: Column, itemset: Column) -> Column:
    return F.size(F.array_except(itemset, basket)) == 0


def words(text: Column) -> Column:
    """Split on single spaces, without the empty strings."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two array<double> columns."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)
