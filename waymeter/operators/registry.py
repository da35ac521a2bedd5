"""Versioned models and the closed loop from a decision to a new model.

A store is a folder on shared storage. A version is there once its record is written, which happens last; a promotion is
one row of its own file, which Spark's commit makes visible as a whole. So a crash at any point leaves the champion as it was.
One job at a time may promote; many may read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.operators.encoding import SparseEncoder
from waymeter.operators.features import FeatureModel
from waymeter.operators.newton import NewtonModel
from waymeter.params import TARGET

KINDS = {c.__name__: c for c in (LinearRegressionModel, RandomForestRegressionModel, GBTRegressionModel, NewtonModel, SparseEncoder, FeatureModel)}
Encoder = SparseEncoder | FeatureModel

RECORD = "version int, encoder string, model string, note string"
POINTER = "commit int, version int"
OUTCOME = "action string, champion int, candidate int, champion_rmse double, candidate_rmse double, reason string"


@dataclass
class ModelStore:
    """Models by version below ``path``."""

    spark: SparkSession
    path: str

    def _rows(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).json(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _put(self, name: str, rows: list[tuple], schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("error").json(f"{self.path}/{name}")

    def records(self) -> DataFrame:
        """(version, encoder, model, note) of every whole version."""
        return self._rows("records/*", RECORD)

    def publish(self, encoder: Encoder, model: Model, note: str = "") -> int:
        """Store a model as the next version; it is not yet the champion."""
        version = (self.records().agg(F.max("version")).first()[0] or 0) + 1
        folder = f"{self.path}/models/version={version}"
        encoder.save(self.spark, f"{folder}/encoder")
        # What an attempt that ended before its record left behind is overwritten.
        model.write().overwrite().save(f"{folder}/model")
        self._put(f"records/{version}", [(version, type(encoder).__name__, type(model).__name__, note)], RECORD)
        return version

    def promote(self, version: int) -> None:
        if self.records().where(F.col("version") == version).isEmpty():
            raise ValueError(f"there is no version {version}")
        commit = (self.promotions().agg(F.max("commit")).first()[0] or 0) + 1
        self._put(f"champion/{commit}", [(commit, version)], POINTER)

    def promotions(self) -> DataFrame:
        """(commit, version): every champion so far."""
        return self._rows("champion/*", POINTER)

    def champion(self) -> int | None:
        """The version promoted last, None before the first promotion."""
        return self.promotions().agg(F.max_by("version", "commit")).first()[0]

    def load(self, version: int) -> tuple[Encoder, Model]:
        record = self.records().where(F.col("version") == version).first()
        if record is None:
            raise ValueError(f"there is no version {version}")
        folder = f"{self.path}/models/version={version}"
        return KINDS[record["encoder"]].load(self.spark, f"{folder}/encoder"), KINDS[record["model"]].load(f"{folder}/model")


def rmse(encoder: Encoder, model: Model, rows: DataFrame, target: str = TARGET) -> float | None:
    """Error of a model on trips with features and the actual duration; None without rows."""
    scored = model.copy().setPredictionCol("_p").transform(encoder.assemble(encoder.transform(rows, keep=[target])))
    error = F.col("_p") - F.col(target)
    return scored.agg(F.sqrt(F.avg(error * error))).first()[0]


def act_on(decision: DataFrame, store: ModelStore, fit: Callable[[], tuple[Encoder, Model]], rows: DataFrame, target: str = TARGET) -> DataFrame:
    """Do what a decision of :func:`~waymeter.operators.policy.retrain_decision` says; one row of what was done.

    ``kept``: no retraining was asked for. Otherwise ``fit`` gives a candidate, which is stored and compared with the
    champion on ``rows``: ``promoted`` if its error is lower or there is no champion, else ``rejected``. ``failed``: the fit raised or
    the candidate can't be measured; the champion stays and the reason says why.
    """
    champion = store.champion()
    before = rmse(*store.load(champion), rows, target) if champion is not None else None

    def outcome(action: str, candidate: int | None = None, error: float | None = None, reason: str = "") -> DataFrame:
        return store.spark.createDataFrame([(action, store.champion(), candidate, before, error, reason)], OUTCOME)

    if not decision.select("retraining_triggered").first()[0]:
        return outcome("kept")
    try:
        encoder, model = fit()
        error = rmse(encoder, model, rows, target)
    except Exception as e:  # whatever stops a fit must not stop serving
        return outcome("failed", reason=f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500])
    version = store.publish(encoder, model, note="retrained")
    if error is None:
        return outcome("failed", version, reason="no rows to compare on")
    if before is not None and error >= before:
        return outcome("rejected", version, error)
    store.promote(version)
    return outcome("promoted", version, error)
