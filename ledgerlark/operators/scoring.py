"""A fitted model that scores batches and streams alike, and its storage."""

import json
from dataclasses import asdict, dataclass, replace
from typing import Any, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.operators import preprocess
from ledgerlark.operators.boosting import Tree
from ledgerlark.operators.forests import ForestTree
from ledgerlark.operators.preprocess import Fitted, encode_by_join, require_features


@dataclass
class ScoringModel:
    """Preprocessing and classifier as one ``PipelineModel``, with the decision threshold."""

    features: list[str]
    pipeline: PipelineModel
    threshold: float = 0.5
    modes: dict[str, str] | None = None
    joined: list[str] | None = None
    code_table: DataFrame | None = None
    unseen: float = -1.0

    @classmethod
    def of(cls, fitted: Fitted, classifier, threshold: float = 0.5) -> "ScoringModel":
        steps = preprocess.stages(fitted).stages + [classifier]
        return cls(fitted.numeric + fitted.categorical, PipelineModel(stages=steps), threshold,
                   fitted.modes, fitted.joined, fitted.code_table, fitted.unseen)

    def probability(self, df: DataFrame, name: str = "fraud_probability") -> DataFrame:
        """All columns of ``df`` plus the probability; fails early when a feature is missing."""
        require_features(df, self.features)
        wide = df
        if self.joined:
            wide = encode_by_join(wide, self.joined, self.code_table, self.modes, self.unseen)
        scored = self.pipeline.transform(wide)
        return scored.select(*[F.col(f"`{c}`") for c in df.columns],
                             vector_to_array("probability")[1].alias(name))

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and ``fraud_probability``."""
        return (self.probability(df)
                .withColumn("prediction", decide(F.col("fraud_probability"), self.threshold)))

    # --- storage ---

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        about = {"features": self.features, "threshold": self.threshold, "modes": self.modes,
                 "joined": self.joined, "unseen": self.unseen}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        if self.joined:
            self.code_table.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ScoringModel | TreeModel":
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        if "trees" in about:
            return TreeModel.told(about, spark.read.parquet(f"{path}/codes") if about["joined"] else None)
        codes = spark.read.parquet(f"{path}/codes") if about["joined"] else None
        return cls(about["features"], PipelineModel.load(f"{path}/pipeline"), about["threshold"],
                   about["modes"], about["joined"], codes, about.get("unseen", -1.0))


@dataclass
class TreeModel:
    """Preprocessing and trees that were grown on bins, with the decision threshold; scores and is stored as a ``ScoringModel``."""

    fitted: Fitted
    edges: list[np.ndarray]
    trees: list[Tree] | list[ForestTree]
    boosted: bool
    gains: list[float]
    threshold: float = 0.5

    @property
    def features(self) -> list[str]:
        return self.fitted.numeric + self.fitted.categorical

    def probability(self, df: DataFrame, name: str = "fraud_probability") -> DataFrame:
        """All columns of ``df`` plus the probability; fails early when a feature is missing."""
        edges, trees, boosted, missing = self.edges, self.trees, self.boosted, np.array([len(e) + 1 for e in self.edges])

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                values = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
                bins = np.stack([np.where(np.isnan(v), len(e) + 1, np.searchsorted(e, v, side="left")) for v, e in zip(values, edges)], axis=1)
                bins = np.asfortranarray(bins.astype(np.uint16))
                margin = sum((t.scores(bins, missing) for t in trees), np.zeros(len(bins)))
                yield pd.Series(1 / (1 + np.exp(-margin)) if boosted else np.clip(margin, 0.0, 1.0))

        # Bins are bounded by values as they are: numbers are imputed, not scaled.
        plain = replace(self.fitted, means=dict.fromkeys(self.fitted.medians, 0.0), deviations=dict.fromkeys(self.fitted.medians, 1.0))
        wide = preprocess.transform(df, plain)
        names = [preprocess.scaled_name(c) for c in self.fitted.numeric] + [preprocess.code_name(c) for c in self.fitted.categorical]
        return wide.select(*[F.col(f"`{c}`") for c in df.columns], score(*[F.col(f"`{c}`") for c in names]).alias(name))

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and ``fraud_probability``."""
        return self.probability(df).withColumn("prediction", decide(F.col("fraud_probability"), self.threshold))

    def importances(self) -> list[float]:
        """The share of all gains by feature."""
        total = sum(self.gains) or 1.0
        return [g / total for g in self.gains]

    def save(self, path: str) -> None:
        spark, joined = SparkSession.active(), self.fitted.joined
        about = {"fitted": {k: v for k, v in vars(self.fitted).items() if k != "code_table"}, "edges": [e.tolist() for e in self.edges],
                 "trees": [asdict(t) for t in self.trees], "boosted": self.boosted, "gains": list(self.gains), "threshold": self.threshold, "joined": joined}
        spark.createDataFrame([(json.dumps(about, default=np.ndarray.tolist),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        if joined:
            self.fitted.code_table.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def told(cls, about: dict, codes: DataFrame | None) -> "TreeModel":
        return cls(Fitted(**about["fitted"], code_table=codes), [np.array(e, dtype=np.float64) for e in about["edges"]],
                   [(Tree if "depth" in t else ForestTree)(**t) for t in about["trees"]], about["boosted"], about["gains"], about["threshold"])


# --- foreign models -------------------------------------------------------------------------

MAX_MODEL_BYTES = 256 << 20      # of a model that is broadcast


def foreign_scorer(spark: SparkSession, model: Any, features: list[str], threshold: float = 0.5, max_bytes: int = MAX_MODEL_BYTES):
    """A vectorised UDF for a model outside MLlib: anything with ``predict_proba(pandas frame)``.

    The model travels to the executors once, as a broadcast variable, and is opened once per task. Returns
    a function that adds ``prediction`` and ``fraud_probability`` to a frame. A model of more than ``max_bytes`` is refused: every
    task holds it.
    """
    packed = cloudpickle.dumps(model)
    if len(packed) > max_bytes:
        raise ValueError(f"the model has {len(packed)} bytes, more than the {max_bytes} that are broadcast")
    shipped = spark.sparkContext.broadcast(packed)

    @F.pandas_udf("struct<prediction int, fraud_probability double>")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        opened = cloudpickle.loads(shipped.value)
        for columns in batches:
            probability = opened.predict_proba(pd.concat(columns, axis=1, keys=features))[:, 1]
            yield pd.DataFrame({"prediction": (probability >= threshold).astype("int32"),
                                "fraud_probability": probability})

    def apply(df: DataFrame) -> DataFrame:
        require_features(df, features)
        return unpack(df.withColumn("scored", score(*[F.col(c) for c in features])), "scored")

    return apply


def unpack(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as columns, in place of the struct."""
    return df.select(*[c for c in df.columns if c != column], f"{column}.*")


def decide(probability: Column, threshold: float = 0.5) -> Column:
    return (probability >= threshold).cast("int")
