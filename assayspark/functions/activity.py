"""Scalar expressions on measured values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Class bounds (a class holds lower <= value < upper) and their names, in order.
CLASS_BOUNDS = (6.0, 7.0, 8.0)
CLASS_NAMES = ("Low", "Moderate", "High", "Very High")

# Scale of a concentration unit in mol/l.
UNIT_SCALE = {"nM": 1e-9, "uM": 1e-6, "μM": 1e-6, "pM": 1e-12}

# Measurements outside this open interval are errors.
VALUE_RANGE = (0.0, 1e7)

# Fixed values: (flag, property, limit); a row violates a rule when the property is above the limit.
DRUG_RULES = (
    ("mw_over_500", "mw", 500.0),
    ("logp_over_5", "logp", 5.0),
    ("hbd_over_5", "hbd", 5.0),
    ("hba_over_10", "hba", 10.0),
)


def no_nan(x: Column) -> Column:
    """NaN to null, so that comparisons and statistics skip it. The input is evaluated once."""
    return F.nanvl(x, F.lit(None).cast("double"))


# Fixed value: what counts as a decimal number; type suffixes and hexadecimal forms do not.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(x: Column) -> Column:
    """Text to double; text that is no decimal number becomes null instead of failing the job."""
    return no_nan(F.when(x.rlike(NUMBER), F.trim(x).try_cast("double")))


def in_open_range(x: Column, low: float = VALUE_RANGE[0], high: float = VALUE_RANGE[1]) -> Column:
    return (x > F.lit(low)) & (x < F.lit(high))


def in_half_open_range(x: Column, low: float, high: float) -> Column:
    return (x >= F.lit(low)) & (x < F.lit(high))


def log_activity(value: Column, scale: float = UNIT_SCALE["nM"]) -> Column:
    """-log10 of a concentration given in units of `scale` mol/l."""
    return -F.log10(value * F.lit(scale))


def log_activity_in(value: Column, unit: Column) -> Column:
    """Unit-aware log activity; an unknown unit gives null."""
    scale = F.lit(None).cast("double")
    for name, factor in UNIT_SCALE.items():
        scale = F.when(unit == name, F.lit(factor)).otherwise(scale)
    return -F.log10(value * scale)


def activity_class(p: Column) -> Column:
    """The class of a log activity; null and NaN have none.

    The bounds are evenly spaced, so one bucket expression finds the class and reads `p` once.
    """
    low, high = CLASS_BOUNDS[0], CLASS_BOUNDS[-1]
    names = F.array(*[F.lit(name) for name in CLASS_NAMES])
    bucket = F.width_bucket(p.cast("double"), F.lit(low), F.lit(high), F.lit(len(CLASS_BOUNDS) - 1))
    return F.get(names, bucket.cast("int"))


def violation_flags(columns: dict[str, str], rules: Sequence[tuple[str, str, float]] = DRUG_RULES) -> dict[str, Column]:
    """One 0/1 column per rule; `columns` maps a rule's property to the column that holds it."""
    return {
        flag: F.coalesce((no_nan(F.col(columns[prop]).cast("double")) > limit).cast("int"), F.lit(0))
        for flag, prop, limit in rules
    }


def violation_count(columns: dict[str, str], rules: Sequence[tuple[str, str, float]] = DRUG_RULES) -> Column:
    flags = list(violation_flags(columns, rules).values())
    total = flags[0]
    for flag in flags[1:]:
        total = total + flag
    return total


def row_label(parts: Sequence[Column], separator: str = "<br>") -> Column:
    """Join the parts that are not null."""
    return F.concat_ws(separator, *parts)


def subgroup_count_rule(n: Column) -> Column:
    """Number of subgroups by group size."""
    # Size bounds and the counts they give.
    return F.when(n < 60, 2).when(n < 150, 3).when(n < 300, 4).when(n < 600, 5).otherwise(6)


def marker_size(n: Column) -> Column:
    """Marker size for a plot of n points, between 3 and 8."""
    return F.least(F.lit(8), F.greatest(F.lit(3), (F.lit(10000) / n).cast("int")))


def largest_subgroup_count(n: Column) -> Column:
    """Upper end of the subgroup counts worth trying for n rows."""
    return F.least(F.lit(10), F.greatest(F.lit(2), (n / 10).cast("int")))
