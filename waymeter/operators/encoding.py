"""Sparse encoding of trips: any number of categories, none of them a column or a node of the plan.

Categories are rows of a table (column, value, place). Rows of trips meet it in a join whose kind the planner picks by its size,
and a place becomes the one stored entry of a sparse vector. :class:`~waymeter.operators.features.FeatureModel` is the dense view of the
same features, a named column for each, for small vocabularies.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.functions.columns import quoted
from waymeter.operators.features import PLACES, FeatureModel, category_counts, numeric_feature
from waymeter.params import CATEGORICAL, NUMERIC, OTHER, TripRules
from waymeter.session import materialize


@dataclass
class SparseEncoder:
    """What feature engineering learned, as a table.

    ``index`` has (column, value, place, baseline): every frequent value of a column; ``place`` counts the columns of a dense view from 0,
    and is null for the baseline, the first training category of a column, and for a frequent place without training rows. ``sizes`` has the
    number of places of each column.
    """

    index: DataFrame
    sizes: dict[str, int]
    numeric: tuple[str, ...] = NUMERIC

    @property
    def size(self) -> int:
        """Length of the feature vector."""
        return len(self.numeric) + sum(self.sizes.values())

    @staticmethod
    def fit(df: DataFrame, is_train: Column, rules: TripRules = TripRules(), fit_on: str = "all") -> SparseEncoder:
        """Learn places and categories as :meth:`FeatureModel.fit` does, with all values left on the cluster.

        Values are numbered by a range partitioning of (column, value): the driver sees one count a partition.
        """
        counts = materialize(category_counts(df, is_train), "categories")
        n = F.col("n_train") if fit_on == "train" else F.col("n_all")
        is_rare = F.col("column").isin(*PLACES) & (n < rules.rare_below)
        other = counts.where(is_rare).groupBy("column").agg(F.sum("n_train").alias("n_train")).select("column", F.lit(OTHER).alias("value"), "n_train")
        kept = counts.where(~is_rare).select("column", "value", "n_train").unionByName(other.where("n_train > 0"))
        kept = kept.groupBy("column", "value").agg(F.sum("n_train").alias("n_train"))
        at = F.coalesce(*[F.when(F.col("column") == c, F.lit(k)) for k, c in enumerate(CATEGORICAL)])
        seen = kept.where("n_train > 0").repartitionByRange(at, "value").sortWithinPartitions(at, "value")
        # Within a partition the id counts the rows, above it stands the partition.
        numbered = materialize(seen.select("column", "value", F.monotonically_increasing_id().alias("_id")), "category-order")
        part = F.shiftright("_id", 33)
        parts = numbered.groupBy(part.alias("p"), "column").agg(F.count("*").alias("n"), F.min("_id").alias("low")).collect()
        sizes, starts = dict.fromkeys(CATEGORICAL, 0), []
        for c in CATEGORICAL:
            rank = 0
            for r in sorted((r for r in parts if r["column"] == c), key=lambda r: r["p"]):
                starts.append((r["p"], c, rank - r["low"]))
                rank += r["n"]
            sizes[c] = max(rank - 1, 0)
        spark = df.sparkSession
        shift = F.broadcast(spark.createDataFrame(starts, "p long, _column string, _shift long"))  # a row a partition and column
        places = numbered.join(shift, (part == F.col("p")) & (F.col("column") == F.col("_column"))).select(
            "column", "value", F.nullif(F.col("_id") + F.col("_shift"), F.lit(0)).alias("rank")
        )
        places = places.select("column", "value", (F.col("rank") - 1).cast("int").alias("place"), F.col("rank").isNull().alias("baseline"))
        unseen = kept.where("n_train = 0").select("column", "value", F.lit(None).cast("int").alias("place"), F.lit(False).alias("baseline"))
        return SparseEncoder(materialize(places.unionByName(unseen), "category-index"), sizes)

    def transform(self, df: DataFrame, keep: Sequence[str] = (), group_rare: bool = True, column: str = "features") -> DataFrame:
        """``keep`` columns, the numeric features and the vector of all features.

        As in :meth:`FeatureModel.transform`: with ``group_rare`` a place that is not frequent counts as "Other", without it has no entry;
        a null has none either.
        """
        others = {r["column"]: r["place"] for r in self.index.where((F.col("value") == OTHER) & F.col("column").isin(*PLACES)).collect()} if group_rare else {}
        used = [c for c, n in self.sizes.items() if n]
        for c in used:
            names = self.index.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("place").alias("_place"), F.lit(True).alias("_known"))
            df = df.join(names, quoted(c) == F.col("_value"), "left")
            place = F.when(F.col("_known"), F.col("_place"))
            if others.get(c) is not None:
                place = place.when(quoted(c).isNotNull(), F.lit(others[c]))
            # A place behind the last stands for none.
            df = df.withColumn(f"_at_{c}", F.coalesce(place, F.lit(self.sizes[c])).cast("double")).drop("_value", "_place", "_known")
        wide = df.select(*[quoted(c) for c in keep], *[numeric_feature(df, c) for c in self.numeric], *[f"_at_{c}" for c in used])
        one_hot = self._one_hot(df.sparkSession, used)
        wide = one_hot.transform(wide) if one_hot else wide
        vector = VectorAssembler(inputCols=[*self.numeric, *[f"_hot_{c}" for c in used]], outputCol=column, handleInvalid="error")
        return vector.transform(wide).drop(*[f"_at_{c}" for c in used], *[f"_hot_{c}" for c in used])

    def _one_hot(self, spark: SparkSession, used: list[str]) -> OneHotEncoderModel | None:
        if not used:
            return None
        last = spark.createDataFrame([tuple(float(self.sizes[c] - 1) for c in used)], [f"_at_{c}" for c in used])
        return OneHotEncoder(inputCols=last.columns, outputCols=[f"_hot_{c}" for c in used], handleInvalid="keep", dropLast=True).fit(last)

    def assemble(self, features: DataFrame) -> DataFrame:
        """The table itself: it has the vector."""
        return features

    def names(self) -> DataFrame:
        """(position, feature) of every element of the vector."""
        spark = self.index.sparkSession
        start = len(self.numeric)
        named = spark.createDataFrame([(k, c) for k, c in enumerate(self.numeric)], "position int, feature string")
        for c, n in self.sizes.items():
            rows = self.index.where((F.col("column") == c) & F.col("place").isNotNull())
            named = named.unionByName(rows.select((F.col("place") + start).alias("position"), F.concat_ws("_", "column", "value").alias("feature")))
            start += n
        return named

    @property
    def columns(self) -> list[str]:
        """Names of the features in order; one a feature, like the weights of a model."""
        return [r["feature"] for r in self.names().orderBy("position").collect()]

    def save(self, spark: SparkSession, path: str) -> None:
        self.index.write.mode("overwrite").parquet(f"{path}/index")
        document = json.dumps({"sizes": self.sizes, "numeric": list(self.numeric)})
        spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SparseEncoder:
        spec = json.loads(spark.read.text(f"{path}/spec").first()["value"])
        return SparseEncoder(spark.read.parquet(f"{path}/index"), spec["sizes"], tuple(spec["numeric"]))

    def dense(self) -> FeatureModel:
        """The dense view. Only for vocabularies that a plan can hold; see :data:`features.DENSE_COLUMNS`."""
        return FeatureModel.of_index(self.index, self.numeric)
