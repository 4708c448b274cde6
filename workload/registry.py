"""The query registry and the views that map the given tables onto the data model.

A view is one SQL text for both engines: Spark binds {table} to a DataFrame, the oracle to the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STRUCTURE = """concat(repeat('C', cast(1 + {k} % 13 as int)), case when {k} >= 52 then repeat('O', cast(1 + floor({k} / 52) % 3 as int)) else '' end,
  repeat('C', cast(floor({k} / 156) % 40 as int)),
  case {k} % 4 when 0 then 'c1ccccc1' when 1 then 'N(C)C'
       when 2 then 'C(=O)Nc1ccc(Cl)cc1' else 'OC1CCNCC1' end,
  case when {k} % 7 = 0 then '.Cl' else '' end)"""

# Ten rows an id, but for one id that a third of all rows has; ids and structures grow with the table.
MOLECULE = "(case when event_id % 3 = 0 then 7 else cast(floor(event_id / 10) as bigint) end)"

ACTIVITY_RAW = (
    f"""select event_id as ord, concat('M', cast({MOLECULE} as varchar(20))) as molecule_id, """
    + STRUCTURE.replace("{k}", MOLECULE)
    + """ as structure,
  case when event_id % 97 = 0 then null
       when event_id % 89 = 0 then 'n/a'
       when event_id % 83 = 0 then '20000000'
       else cast(cast(round(value * case event_id % 4 when 0 then 0.1e0 when 1 then 1e0
                                     when 2 then 10e0 else 100e0 end) as bigint) as varchar(20))
  end as standard_value,
  event_type as standard_type,
  case event_id % 11 when 0 then 'uM' when 1 then 'pM' else 'nM' end as units,
  concat('T', cast({molecule} % 3 as varchar(20))) as target,
  ts as fetched_at
from {events}""".replace("{molecule}", MOLECULE)
)

PROPS = """select *, l_extendedprice/100 as molwt, l_quantity/6 as mollogp, l_linenumber as hbd,
  cast(floor(l_quantity/4) as int) as hba, l_discount*1000 as tpsa, 5e0 as const_col,
  4e0 + l_extendedprice/21000 - l_quantity/50 as pic50,
  cast(l_suppkey % 5 as int) as cluster, cast(l_partkey % 6 as int) as subcluster,
  case when l_partkey % 11 = 0 then '' else concat('S', cast(l_partkey % 11 as varchar(20))) end as scaffold
from {lineitem}"""

STRUCTURES = "select p_partkey as id, " + STRUCTURE.replace("{k}", "p_partkey") + " as structure from {part}"

# Array positions count from 0 in Spark and from 1 in the oracle.
BITS_SPARK = """select vec_id as id, embedding, cast(label as int) as cluster,
  6.5e0 + 8e0 * cast(embedding[0] as double) as pic50,
  transform(embedding, v -> cast(v as double)) as x,
  filter(transform(embedding, (v, i) -> if(v > 0, i, -1)), b -> b >= 0) as bits
from {embeddings}"""
BITS_ORACLE = """select vec_id as id, embedding, cast(label as int) as cluster,
  6.5e0 + 8e0 * cast(embedding[1] as double) as pic50,
  list_transform(embedding, lambda v: cast(v as double)) as x,
  list_filter(list_transform(embedding, lambda v, i: case when v > 0 then cast(i - 1 as int) else -1 end),
              lambda b: b >= 0) as bits
from embeddings"""

TABLES = ("events", "lineitem", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [t for t in (*TABLES, "embeddings") if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def activity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, ACTIVITY_RAW)


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PROPS)


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, STRUCTURES)


def bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, BITS_SPARK)


def _oracle_view(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


# Cleaned rows, shared by the oracles that start from them.
CLEAN_SQL = """select ord, molecule_id, structure, target, units, -log10(try_cast(trim(standard_value) as double) * 1e-9) as p
from activity_raw where standard_value is not null and structure is not null
  and try_cast(trim(standard_value) as double) > 0 and try_cast(trim(standard_value) as double) < 1e7"""

VIEWS = {
    "activity_raw": _oracle_view(ACTIVITY_RAW),
    "clean": CLEAN_SQL,
    "props": _oracle_view(PROPS),
    "structures": _oracle_view(STRUCTURES),
    "bits": BITS_ORACLE,
}


def oracle(sql: str, *views: str) -> str:
    """SQL with the named views in front of it."""
    if not views:
        return sql
    ctes = [f"{v} as ({VIEWS[v]})" for v in views]
    sql = sql.strip()
    if sql.startswith("with "):
        return "with " + ", ".join(ctes) + ", " + sql[5:]
    return "with " + ", ".join(ctes) + " " + sql


def query(name: str, sql: str | None = None, *views: str) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql, *views)
        return fn

    return register


def r6(c: Column | str) -> Column:
    """Round to 6 digits, never to a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def q6(expr: str) -> str:
    return f"(round({expr}, 6) + 0e0)"
