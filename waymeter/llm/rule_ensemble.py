"""Quality classifier: conjunctive rules from tree paths, weighted by a lasso logistic fit.

Shallow forest trees over document statistics are cut into their paths; each path is a rule "a < x <= b and
...". A logistic regression with an absolute penalty keeps few rules, and those become one Spark column
expression. Both fits are MLlib's and read a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.llm import stats

#: At most so many labelled documents are fitted (the bound of the sample).
SAMPLE_ROWS = 20_000
FOLDS = 5
#: Fixed value of the contract: label 1 is predicted from this score on.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool
    value: float


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self, features: dict[str, Column]) -> Column:
        """The probability of label 1 as one expression over the statistics."""
        terms = [F.when(holds(r, features), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights, strict=True)]
        return 1 / (1 + F.exp(-reduce(add, terms, F.lit(self.intercept))))


def holds(rule: Rule, features: dict[str, Column]) -> Column:
    names = stats.FEATURES
    return reduce(and_, [(features[names[c.feature]] > c.value) if c.above else (features[names[c.feature]] <= c.value) for c in rule])


def paths(node, before: Rule = ()) -> list[Rule]:
    """The conditions from the root to every node below it."""
    if node.numDescendants() == 0:
        return [before] if before else []
    f, t = node.split().featureIndex(), float(node.split().threshold())
    out = [before] if before else []
    for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
        out += paths(child, (*before, Condition(f, above, t)))
    return out


def tighten(rule: Rule) -> Rule:
    """One lower and one upper bound a feature, in a fixed order."""
    bounds: dict[tuple[int, bool], float] = {}
    for c in rule:
        k = (c.feature, c.above)
        bounds[k] = c.value if k not in bounds else (max if c.above else min)(bounds[k], c.value)
    return tuple(Condition(f, a, v) for (f, a), v in sorted(bounds.items()))


def fit(
    spark: SparkSession, x: np.ndarray, y: np.ndarray, *, trees: int = 12, depth: int = 3, penalty: float = 0.0003, rounds: int = 60
) -> Ensemble:
    """Rules of a forest, then their weights. Without rows or with one class: the smoothed share of label 1."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble((), (), math.log(share / (1 - share)))
    rows = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y, strict=True)], "x array<double>, label double")
    rows = rows.repartition(4).select(array_to_vector("x").alias("features"), "x", "label").persist()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=20, seed=1, featureSubsetStrategy="all", subsamplingRate=0.6)
    model = forest.fit(rows)
    found = {tighten(p) for t in model._java_obj.trees() for p in paths(t.rootNode())}
    rules = sorted(found, key=lambda r: [(c.feature, c.above, c.value) for c in r])
    if not rules:
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble((), (), math.log(share / (1 - share)))
    named = dict(zip(stats.FEATURES, [F.col("x")[k] for k in range(len(stats.FEATURES))], strict=True))
    marks = F.array(*[holds(r, named).cast("double") for r in rules])
    ready = rows.select(array_to_vector(marks).alias("features"), "label")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=rounds, standardization=False).fit(ready)
    rows.unpersist()
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return Ensemble(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso.intercept))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Ensemble:
    x, y = stats.labelled_sample(docs, labels, label, rows, FOLDS)
    return fit(docs.sparkSession, x, y)


def score(docs: DataFrame, ensemble: Ensemble, name: str) -> DataFrame:
    """``docs`` with the double column ``name``: the probability of label 1, for empty and null texts too. No shuffle.

    Rows are scored one by one; repeated rows and null ids pass through, an empty table gives none.
    """
    counts = stats.unused(docs, "_counts")
    out = stats.with_counts(docs, counts)
    return out.withColumn(name, ensemble.column(stats.ratio_columns(F.col(f"`{counts}`")))).drop(counts)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be of label 1, with all their columns."""
    name = stats.unused(docs, "_score")
    return score(docs, train(docs, labels), name).where(F.col(f"`{name}`") >= THRESHOLD).drop(name)
