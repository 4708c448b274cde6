"""Files: tables, text lines, text reports, run-partitioned layouts and the inventory of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV file with a header. Give the schema: without one, every column arrives as text."""
    reader = spark.read.option("header", True).option("multiLine", False)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_table(df: DataFrame, path: str, file_format: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the table at `path`."""
    writer = df.write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def trim_any(text: Column) -> Column:
    """Strip white space of every kind, tabs and carriage returns included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def non_blank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(trim_any(F.col(column)).alias(column)).where(F.length(column) > 0)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One value per line, trimmed, blank lines dropped, in a column `value`."""
    return non_blank_lines(spark.read.text(path))


def structure_column(columns: list[str]) -> str:
    """The first column named like structures, else the first column."""
    return next((c for c in columns if "smiles" in c.lower()), columns[0])


def read_structures(spark: SparkSession, path: str, name: str = "structure") -> DataFrame:
    """Structures to score: the structure column of a CSV, Parquet or text file, by suffix."""
    if path.rstrip("/").endswith(".csv"):
        table = read_csv(spark, path)
    elif path.rstrip("/").endswith(".parquet"):
        table = spark.read.parquet(path)
    else:
        return read_lines(spark, path).withColumnRenamed("value", name)
    return table.select(F.col(f"`{structure_column(table.columns)}`").alias(name))


def write_report(lines: DataFrame, column: str, path: str) -> None:
    """A text report, one formatted line per row."""
    lines.select(column).write.mode("overwrite").text(path)


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of the files under a folder; their content is never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", "modificationTime")
        .withColumn("file", F.element_at(F.split("path", "/"), -1))
    )


def run_inventory(files: DataFrame, run_pattern: str, kinds: dict[str, str]) -> DataFrame:
    """Per run: how many files, their bytes, the last change, and which kinds of artefact exist.

    `run_pattern` is a regular expression whose first group is the run; `kinds` maps a flag to a
    regular expression on the path.
    """
    run = F.regexp_extract("path", run_pattern, 1)
    return (
        files.withColumn("run_id", run)
        .where(F.length("run_id") > 0)
        .groupBy("run_id")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("changed_at"),
            *[F.bool_or(F.col("path").rlike(p)).alias(flag) for flag, p in kinds.items()],
        )
    )


def run_id_of(day: Column) -> Column:
    """The run of a day, as YYYYMMDD."""
    return F.date_format(day, "yyyyMMdd")


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write one run into a table partitioned by run; other runs stay.

    The run's own folder is overwritten, so no session-wide overwrite mode is needed.
    """
    if not run_id:
        raise ValueError("run_id must not be empty")
    df.drop("run_id").write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """One run of a run-partitioned table; other runs' files are pruned."""
    return spark.read.parquet(path).where(F.col("run_id") == run_id)
