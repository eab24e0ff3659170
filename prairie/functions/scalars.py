"""Scalar functions, all built from JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prairie.functions import as_column as _col


# Dates -----------------------------------------------------------------------------

def month_number(c) -> Column:
    return F.month(_col(c))


def month_name(c) -> Column:
    """Full English month name, ``June``."""
    return F.date_format(_col(c), "MMMM")


def month_is(c, month: int) -> Column:
    return F.month(_col(c)) == month


def date_text(c) -> Column:
    """The date part (first 10 characters) of a date-time text, NULL if it is shorter."""
    c = _col(c)
    return F.when(F.length(c) >= 10, F.substring(c, 1, 10))


# Text and numbers ------------------------------------------------------------------

def safe_double(c) -> Column:
    """Text to double; NULL when the text is not a number."""
    return _col(c).try_cast("double")


def same_text(a, b) -> Column:
    """Equality that ignores case."""
    return F.lower(_col(a)) == F.lower(_col(b))


def zero_if_null(c) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def path_part(c) -> Column:
    """Second part of an ``a/b/c`` path; empty text when there are fewer than three parts."""
    parts = F.split(_col(c), "/", -1)
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(1))).otherwise(F.lit(""))


def prefix_label(c, prefix: str) -> Column:
    """1 if the text starts with ``prefix``, else 0."""
    return F.startswith(_col(c), F.lit(prefix)).cast("int")


def snippet(c, width: int = 300) -> Column:
    """The first characters of a text on one line."""
    return F.translate(F.substring(_col(c), 1, width), "\n", " ")


def six_decimals(c) -> Column:
    """Text with six digits after the point; NULL stays NULL.

    Halves of the decimal text are rounded up (``0.0000005`` gives ``0.000001``).
    """
    c = _col(c).cast("double")
    return F.when(c.isNotNull(), F.format_string("%.6f", c))


def trimmed(c) -> Column:
    """Without blanks and U+0009 to U+000D at both ends."""
    return F.btrim(_col(c), F.lit(" \t\n\x0b\x0c\r"))


# Model arithmetic ------------------------------------------------------------------

def sigmoid(z) -> Column:
    """1 / (1 + exp(-z)) without overflow for large |z|."""
    z = _col(z)
    small = F.exp(-F.abs(z))
    return F.when(z >= 0, 1 / (1 + small)).otherwise(small / (1 + small))


def log1p_exp(z) -> Column:
    """ln(1 + exp(z)) without overflow for large z."""
    z = _col(z)
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0))


def logit(p) -> Column:
    """ln(p / (1 - p)), NULL outside (0, 1)."""
    p = _col(p)
    return F.when((p > 0) & (p < 1), F.log(p / (1 - p)))


def idf_log10(n, df) -> Column:
    """log10(n / df); a word that occurs in no document counts as one that occurs in one."""
    df = _col(df)
    return F.log10(_col(n).cast("double") / F.when(df > 0, df).otherwise(1))


def idf_ln(n, df) -> Column:
    """ln(n / df), 0 where the word occurs in no document."""
    df = _col(df)
    return F.when(df > 0, F.log(_col(n).cast("double") / df)).otherwise(F.lit(0.0))


def _log_choose(n: Column, k: Column) -> Column:
    """ln of the binomial coefficient for 0 <= k <= n."""
    few = F.least(k, n - k).cast("int")
    steps = F.when(few > 0, F.sequence(F.lit(1), few)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.log((n - few + i) / i))


def choose(n, k) -> Column:
    """Binomial coefficient as a double; 0 outside 0 <= k <= n, NULL for a NULL."""
    n, k = _col(n), _col(k)
    few = F.least(k, n - k).cast("int")
    steps = F.when(few > 0, F.sequence(F.lit(1), few)).otherwise(F.array().cast("array<int>"))
    product = F.aggregate(steps, F.lit(1.0), lambda acc, i: acc * (n - few + i) / i)
    return F.when(n.isNull() | k.isNull(), None).when((k < 0) | (k > n), 0.0).otherwise(product)


def binomial_pmf(k, n, p) -> Column:
    """Probability of k successes in n trials, by a sum of logarithms and one exp."""
    k, n, p = _col(k), _col(n), p if isinstance(p, Column) else F.lit(float(p))
    inside = F.exp(_log_choose(n, k) + k * F.log(p) + (n - k) * F.log(1 - p))
    return (
        F.when(n.isNull() | k.isNull() | p.isNull(), None)
        .when((k < 0) | (k > n), 0.0)
        .when(p <= 0, F.when(k == 0, 1.0).otherwise(0.0))
        .when(p >= 1, F.when(k == n, 1.0).otherwise(0.0))
        .otherwise(inside)
    )


def distance(a, b) -> Column:
    """Euclidean distance of two equally long arrays, for single rows (pairs: operators.neighbours)."""
    gaps = F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x))


def presence(c) -> Column:
    """Counts clipped to 0 or 1."""
    return F.least(F.greatest(_col(c), F.lit(0)), F.lit(1))
