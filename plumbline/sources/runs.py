"""Stored models and an append-only log of training runs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from plumbline.operators.models import Neighbours
from plumbline.sources.files import list_names

RUN_SCHEMA = ("run_id string, parent_run_id string, name string, started timestamp, params map<string,string>, "
              "metrics map<string,double>, tags map<string,string>")


def save_model(model: PipelineModel | Neighbours, folder: str, name: str) -> str:
    path = f"{str(folder).rstrip('/')}/{name}"
    if isinstance(model, Neighbours):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(folder: str, name: str, spark: SparkSession | None = None) -> PipelineModel | Neighbours:
    """A stored pipeline, or the k-NN model that lies there."""
    path = f"{str(folder).rstrip('/')}/{name}"
    spark = spark or SparkSession.getActiveSession()
    if "index" in list_names(spark, path):
        return Neighbours.load(spark, path)
    return PipelineModel.load(path)


def model_names(spark: SparkSession, folder: str) -> list[str]:
    return list_names(spark, folder)


def log_run(spark: SparkSession, path: str, name: str, params: Mapping[str, object] | None = None,
            metrics: Mapping[str, float] | None = None, tags: Mapping[str, str] | None = None,
            parent: str | None = None) -> str:
    """Append one run to the Parquet log and return its id; ``parent`` nests it."""
    run_id = uuid.uuid4().hex
    row = (run_id, parent, name, datetime.now(timezone.utc),
           {k: str(v) for k, v in (params or {}).items()},
           {k: float(v) for k, v in (metrics or {}).items() if v is not None}, dict(tags or {}))
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(str(path))
