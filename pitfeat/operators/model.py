"""Boosted-tree model on feature tables, and batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.operators.evaluate import GREEN, RED, band


def pipeline(
    numeric: list[str], categorical: list[str], label: str, seed: int = 1, **trees
) -> Pipeline:
    """Median fill, one-hot with unknown values ignored, gradient-boosted trees."""
    filled = [f"{c}__f" for c in numeric]
    index = [f"{c}__i" for c in categorical]
    onehot = [f"{c}__o" for c in categorical]
    stages = [
        Imputer(inputCols=numeric, outputCols=filled, strategy="median"),
        StringIndexer(
            inputCols=categorical, outputCols=index, handleInvalid="keep",
            stringOrderType="frequencyDesc",
        ),
        OneHotEncoder(inputCols=index, outputCols=onehot, handleInvalid="keep", dropLast=True),
        VectorAssembler(inputCols=[*filled, *onehot], outputCol="features"),
        GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **trees),
    ]
    return Pipeline(stages=stages)


def one_hot(df: DataFrame, categorical: list[str], known: DataFrame | None = None) -> DataFrame:
    """Each column as an array with a 1 at the place of its value, most frequent first.

    Places come from ``known`` (by default the rows themselves); of equally frequent values
    the smaller comes first. A null or a value that is not known has zeros only.
    """
    index = [f"_{c}_i" for c in categorical]
    stages = Pipeline(stages=[
        StringIndexer(inputCols=categorical, outputCols=index, handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=index, outputCols=[f"_{c}_o" for c in categorical], handleInvalid="keep"),
    ]).fit(df if known is None else known)
    d = stages.transform(df)
    # the last place is that of unknown values
    d = d.withColumns({f"_{c}_a": vector_to_array(f"_{c}_o") for c in categorical})
    d = d.withColumns({c: F.slice(f"_{c}_a", F.lit(1), F.size(f"_{c}_a") - 1) for c in categorical})
    return d.select(*df.columns)


def fit(df: DataFrame, numeric, categorical, label, seed: int = 1, **trees) -> PipelineModel:
    """Fit on rows that are computed once: the stages read them many times."""
    rows = cut_lineage(df.select(*numeric, *categorical, label))
    return pipeline(numeric, categorical, label, seed, **trees).fit(rows)


def tune(
    df: DataFrame, numeric, categorical, label, grid: dict[str, list], seed: int = 1
) -> PipelineModel:
    """Best model of a parameter grid by area under the precision-recall curve."""
    df = cut_lineage(df.select(*numeric, *categorical, label))
    stages = pipeline(numeric, categorical, label, seed)
    trees = stages.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(trees.getParam(name), values)
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    return TrainValidationSplit(
        estimator=stages, estimatorParamMaps=builder.build(), evaluator=judge, seed=seed
    ).fit(df).bestModel


def score(
    df: DataFrame, model: PipelineModel, cuts: list[float], names: list[str] | None = None,
    name: str = "ml_probability", decision: str = "payout_decision",
) -> DataFrame:
    """Add the probability of class 1 and the band it falls in."""
    d = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    d = d.withColumn(decision, band(name, cuts, names or [GREEN, RED]))
    return d.select(*[F.col(c) for c in df.columns], name, decision)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
