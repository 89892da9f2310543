"""Small column functions: paths, buckets, defaults, shares."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def dirname(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*\z", "")).otherwise(F.lit(""))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def relative(path: Column, prefix: Column) -> Column:
    """The path below a prefix; the whole path for the empty prefix; null when it isn't below."""
    return F.when(prefix == "", path).when(F.startswith(path, F.concat(prefix, F.lit("/"))), F.substr(path, F.length(prefix) + 2))


def safe_segments(path: Column) -> Column:
    """Everything but letters, digits, dots, dashes and underscores in a path's segments becomes an underscore."""
    return F.regexp_replace(path, r"[^A-Za-z0-9._/-]", "_")


def ancestors(path: Column) -> Column:
    """All directories a path lies in, the empty one first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def or_else(value: Column, default: str) -> Column:
    """A default for null and for the empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


# Lower bounds and names.
STAR_BUCKETS = [(10_000, "10k+"), (1_000, "1k-10k"), (100, "100-1k"), (10, "10-100"), (1, "1-10")]


def star_bucket(stars: Column) -> Column:
    out = None
    for least, name in STAR_BUCKETS:
        out = (F if out is None else out).when(F.coalesce(stars, F.lit(0)) >= least, name)
    return out.otherwise("0")


def share(n: Column, *group: str) -> Column:
    """Percent of a count in its group's sum, to two places."""
    return F.round(100 * n / F.sum(n).over(Window.partitionBy(*group)), 2)


def scaled(value: Column, factor: Column) -> Column:
    """An extrapolated count, cut to a whole number."""
    return (value.cast("double") * factor).cast("bigint")
