"""Score structures with a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayspark.functions import activity as act, structure as st
from assayspark.operators import clean, features as ft, groups, models, similarity, stats
from assayspark.sources import files


class Predictor:
    """Featurise, reject what has no bits, predict, class and rank.

    `n_bits` and `window` must be those the model was fitted with. Checks and the applicability domain need no model.
    """

    def __init__(self, spark: SparkSession, model: models.TreeModel | str | None, n_bits: int = 2048, window: int = 4, summary: str | None = None):
        self.spark = spark
        self.model = models.load_model(model) if isinstance(model, str) else model
        self.n_bits, self.window = n_bits, window
        self.summary = spark.read.parquet(summary) if summary else None

    def _table(self, structures: DataFrame | str | Sequence[str]) -> DataFrame:
        if isinstance(structures, DataFrame):
            return structures
        values = [structures] if isinstance(structures, str) else list(structures)
        return self.spark.createDataFrame([(v,) for v in values], "structure string")

    def checked(self, structures: DataFrame | str | Sequence[str]) -> DataFrame:
        """All rows with `bits` and `error`; the error is null where a row can be scored."""
        made = self._table(structures).withColumn("bits", st.hashed_bits(F.col("structure"), self.n_bits, self.window))
        return clean.split_valid(
            made,
            {"no structure": F.col("structure").isNull(), "structure too short": F.size("bits") == 0},
        )

    def predict(self, structures: DataFrame | str | Sequence[str], ordered: bool = True) -> DataFrame:
        """(input columns, prediction, class) of the valid rows, largest prediction first."""
        valid = ft.bits_to_vector(self.checked(structures).where("error is null"), "bits", "features", self.n_bits)
        scored = (
            models.predictions(self.model, valid)
            .withColumn("class", act.activity_class(F.col("prediction")))
            .drop("bits", "features", "error")
        )
        others = [c for c in scored.columns if c not in ("prediction", "class")]
        return groups.sort_desc(scored, "prediction", others) if ordered else scored

    def rejected(self, structures: DataFrame | str | Sequence[str]) -> DataFrame:
        return self.checked(structures).where("error is not null").drop("bits")

    def errors(self, structures: DataFrame | str | Sequence[str]) -> DataFrame:
        return clean.error_summary(self.checked(structures), "structure")

    def report(self, structures: DataFrame | str | Sequence[str], strongest: int = 15) -> dict[str, DataFrame]:
        """The scored table with labels, the strongest rows, and rows per class."""
        scored = self.predict(structures, ordered=False)
        label = F.format_string("pIC50: %.2f (%s)", "prediction", "class")
        ties = [c for c in scored.columns if c not in ("prediction", "class")]
        return {
            "table": groups.sort_desc(scored.withColumn("label", label), "prediction", ties),
            "strongest": groups.top_n(scored, "prediction", strongest, ties),
            "classes": stats.class_distribution(scored, "prediction"),
        }

    def screen(self, path: str, output: str, n: int = 50) -> dict[str, DataFrame]:
        """Score a library file; all rows and the n best are written and read back."""
        everything = f"{output.rstrip('/')}/all"
        best = f"{output.rstrip('/')}/top"
        files.write_table(self.predict(files.read_structures(self.spark, path), ordered=False), everything)
        scored = self.spark.read.parquet(everything)
        files.write_table(groups.top_n(scored, "prediction", n, ["structure"]), best)
        return {"all": scored, "top": self.spark.read.parquet(best)}

    def applicability(self, structures: DataFrame, training: DataFrame, threshold: float = 0.5, id: str = "id") -> DataFrame:
        """Per structure, whether a training structure is similar enough, which one, and how similar."""
        asked = self.checked(structures).where("error is null")
        known = training.select(id, st.hashed_bits(F.col("structure"), self.n_bits, self.window).alias("bits"))
        return similarity.nearest_neighbours(asked.select(id, "bits"), known, threshold, self.n_bits, id, id)
