"""Typing, filtering and duplicate removal of measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import NumericType

from assayspark.functions import activity as act, structure as st
from assayspark.operators.quantiles import GROUP_LIMIT, group_quantiles
from assayspark.session import settle


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are: {', '.join(df.columns)}")


def all_but(df: DataFrame, columns: Sequence[str], prefixes: Sequence[str] = ()) -> DataFrame:
    """Every column but the named ones and those whose name starts with a prefix."""
    kept = [c for c in df.columns if c not in columns and not c.startswith(tuple(prefixes) or ("\0",))]
    return df.select(*[f"`{c}`" for c in kept])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), first: int | None = None) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
    return names[:first]


def resolve_aliases(df: DataFrame, alternatives: Sequence[dict[str, str]]) -> dict[str, str] | None:
    """The first set of names {role: column} that the table has in full, or None."""
    return next((names for names in alternatives if all(c in df.columns for c in names.values())), None)


def with_log_activity(raw: DataFrame, value: str = "standard_value", output: str = "p") -> DataFrame:
    """Raw rows with text values to rows with a log activity in `output`.

    Rows without value or structure, with text that is no number, or outside the accepted range go.
    """
    number = act.to_number(F.col(value))
    return (
        raw.where(F.col(value).isNotNull() & F.col("structure").isNotNull())
        .withColumn("_number", number)
        .where(act.in_open_range(F.col("_number")))
        .withColumn(output, act.log_activity(F.col("_number")))
        .drop("_number")
    )


def split_valid(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add `error`: the first reason whose condition holds, else null. Rows are kept."""
    error = F.lit(None).cast("string")
    for reason, bad in reversed(list(checks.items())):
        error = F.when(bad, F.lit(reason)).otherwise(error)
    return df.withColumn("error", error)


def error_summary(checked: DataFrame, value: str, shown: int = 5) -> DataFrame:
    """The first rejected values with their reason, and how many more there are, in one row."""
    bad = checked.where("error is not null").select(value, "error")
    first = bad.orderBy(value, "error").limit(shown).agg(
        F.sort_array(F.collect_list(F.struct(F.col(value).alias("value"), F.col("error").alias("error")))).alias("f")
    )
    return bad.agg(F.count("*").alias("errors")).select(
        "errors",
        first.scalar().alias("first_errors"),
        F.greatest(F.col("errors") - shown, F.lit(0)).alias("more"),
    )


def drop_exact(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """One row per distinct combination of `columns`, keeping the smallest `order`."""
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def _first_and_median(
    rows: DataFrame, key: str, firsts: dict[str, Column], value: str, limit: int
) -> DataFrame:
    """Per key: some partial aggregates and the exact median. `rows` must be cheap to read twice.

    Every key stays; one without values (null or NaN ones only) has a null median.
    """
    first = rows.groupBy(key).agg(*[c.alias(name) for name, c in firsts.items()])
    return first.join(group_quantiles(rows, [key], value, {value: 0.5}, limit=limit), key, "left")


def collapse_by_id(
    distinct: DataFrame,
    key: str = "molecule_id",
    structure: str = "structure",
    value: str = "p",
    order: str = "ord",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per id: the first structure in source order and the exact median value."""
    rows = settle(distinct.where(F.col(key).isNotNull()), "exact")
    first = F.expr(f"min_by(`{structure}`, `{order}`) filter (where `{structure}` is not null)")
    return _first_and_median(rows, key, {structure: first}, value, limit)


def collapse_by_structure(
    by_id: DataFrame,
    key: Column | None = None,
    id: str = "molecule_id",
    structure: str = "structure",
    value: str = "p",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per structure key: the smallest id, its structure, and the median of the medians."""
    keyed = by_id.withColumn("_key", key if key is not None else st.structure_key(F.col(structure)))
    rows = settle(keyed.where(F.col("_key").isNotNull()), "by_id")
    firsts = {id: F.min(id), structure: F.min_by(structure, id)}
    return _first_and_median(rows, "_key", firsts, value, limit).drop("_key")


def remove_duplicates(
    df: DataFrame, order: str = "ord", key: Column | None = None, value: str = "p", limit: int = GROUP_LIMIT
) -> DataFrame:
    """Three stages: exact rows, ids, structures. Exact copies go first, so they count once in the median.

    The output of each stage is written once to the shared folder, as the next one reads it more than once.
    """
    exact = drop_exact(df, ["molecule_id", "structure", value], order)
    by_id = collapse_by_id(exact, value=value, order=order, limit=limit)
    return collapse_by_structure(by_id, key, value=value, limit=limit)


def duplicate_counts(df: DataFrame, order: str = "ord", key: Column | None = None, value: str = "p") -> DataFrame:
    """Rows left after each stage of `remove_duplicates`, in order, from distinct counts.

    The distinct rows are written once; the later stages count over them, so none is run in full.
    """
    exact = settle(drop_exact(df, ["molecule_id", "structure", value], order), "exact")
    by_id = (
        exact.where("molecule_id is not null")
        .groupBy("molecule_id")
        .agg(F.expr(f"min_by(structure, `{order}`) filter (where structure is not null)").alias("structure"))
    )
    keyed = by_id.withColumn("_key", key if key is not None else st.structure_key(F.col("structure")))
    stages = [
        ("start", df.agg(F.count("*").alias("n"))),
        ("exact", exact.agg(F.count("*").alias("n"))),
        ("id", by_id.agg(F.count("*").alias("n"))),
        ("structure", keyed.where("_key is not null").select("_key").distinct().agg(F.count("*").alias("n"))),
    ]
    out = None
    for i, (name, counted) in enumerate(stages):
        row = counted.select(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col("n").alias("remaining"))
        out = row if out is None else out.unionByName(row)
    return out


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table and an observation whose `get["rows"]` is its row count once any job has run over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def row_loss(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before, kept and lost, in one pass."""
    return df.agg(
        F.count("*").alias("before"),
        F.count(F.when(kept, 1)).alias("kept"),
        (F.count("*") - F.count(F.when(kept, 1))).alias("lost"),
    )
