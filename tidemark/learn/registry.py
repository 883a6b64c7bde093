"""Model registry: one current model per name, the newest five kept."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import newest_per_group
from tidemark.sources.tables import Table, exists, remove

MODELS = (
    "model_id string, name string, trained_at timestamp, data_start timestamp_ntz, data_end timestamp_ntz, "
    "metrics string, artifact string, is_current boolean"
)
KEPT = 5


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.table = Table(spark, f"{path}/registry", MODELS)

    def register(self, name: str, model: PipelineModel, data_start, data_end, metrics: dict, trained_at: dt.datetime | None = None) -> str:
        """Save a model, make it the current one of its name, drop the oldest beyond five."""
        model_id = str(uuid.uuid4())
        artifact = f"{self.path}/models/{model_id}"
        model.write().overwrite().save(artifact)
        at = trained_at or dt.datetime.now(dt.timezone.utc)
        row = (model_id, name, at, data_start, data_end, json.dumps(metrics), artifact, True)
        before = self.table.read().withColumn("is_current", F.col("is_current") & (F.col("name") != name))
        merged = before.unionByName(self.spark.createDataFrame([row], MODELS))
        self.table.replace(newest_per_group(merged, "name", "trained_at", KEPT))
        gone = before.join(self.table.read(), "model_id", "left_anti").select("artifact")
        for r in gone.toLocalIterator():
            if exists(self.spark, r.artifact):
                remove(self.spark, r.artifact)
        return model_id

    def models(self) -> DataFrame:
        return self.table.read()

    def current(self, name: str) -> PipelineModel | None:
        row = self.table.read().where((F.col("name") == name) & F.col("is_current")).orderBy(F.desc("trained_at")).first()
        return PipelineModel.load(row.artifact) if row else None
