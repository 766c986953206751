"""Random forest training and classification."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MAX_CATEGORIES, NUM_TREES
from .features import FEATURE_KEYS
from .trees import Forest

SEED = 42


def stable_layout(fdf: DataFrame, partitions: int | None = None) -> DataFrame:
    """Same rows -> same partitions and order, so a seeded forest gives the
    same votes on every run (tree sampling depends on the layout)."""
    n = partitions or int(fdf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fdf.repartition(n, *FEATURE_KEYS).sortWithinPartitions(*FEATURE_KEYS)


def stages(num_trees: int = NUM_TREES, seed: int = SEED) -> list:
    """M2, not fitted yet: classes by frequency, features with few values as
    categories, forest.  Values that training did not see get a slot of
    their own in both indexers."""
    return [StringIndexer(inputCol="label", outputCol="class", handleInvalid="keep"),
            VectorIndexer(inputCol="features", outputCol="inputs", maxCategories=MAX_CATEGORIES, handleInvalid="keep"),
            Forest(labelCol="class", featuresCol="inputs", inputCols=FEATURE_KEYS, numTrees=num_trees, seed=seed)]


def fit(fdf: DataFrame, num_trees: int = NUM_TREES, seed: int = SEED):
    """Train on a features frame; None when it is empty (A2 guard)."""
    fdf = stable_layout(fdf.where(F.col("label").isNotNull())).persist()
    try:
        if fdf.isEmpty():
            return None
        return Pipeline(stages=stages(num_trees, seed)).fit(fdf)
    finally:
        fdf.unpersist()


def classify(model: PipelineModel, fdf: DataFrame) -> DataFrame:
    """M4: keys + raw votes per class as ``rfrawp`` (a Vector)."""
    return model.transform(fdf).select(*FEATURE_KEYS, F.col("rawPrediction").alias("rfrawp"))


def dedensify(df: DataFrame) -> DataFrame:
    """rfrawp Vector -> array<float> (keys keep their names)."""
    return df.withColumn("rfrawp", vector_to_array("rfrawp", "float32"))


def labels(model: PipelineModel) -> list:
    """Class order of the vote slots (the last slot is 'unknown')."""
    return list(model.stages[0].labels)


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a trained pipeline; the path goes into tile.model."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
