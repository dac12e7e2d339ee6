"""Fitted models with what is needed to apply them: design, price cap and parameters."""

from __future__ import annotations

import json

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from hearthrate.operators.attribution import attribution_long
from hearthrate.operators.design import DesignMatrix


def save_artifact(spark: SparkSession, path: str, model: Model, design: DesignMatrix, **metadata) -> None:
    pipeline = model if isinstance(model, PipelineModel) else Pipeline(stages=[model]).fit(
        spark.createDataFrame([], "label double")
    )
    pipeline.write().overwrite().save(f"{path}/model")
    text = json.dumps({"design": json.loads(design.to_json()), **metadata}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_artifact(spark: SparkSession, path: str) -> tuple[PipelineModel, DesignMatrix, dict]:
    model = PipelineModel.load(f"{path}/model")
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    design = DesignMatrix(**metadata.pop("design"))
    return model, design, metadata


def save_attributions(attributed: DataFrame, key: str, features: list[str], path: str) -> None:
    attribution_long(attributed, key, features).write.mode("overwrite").parquet(path)
