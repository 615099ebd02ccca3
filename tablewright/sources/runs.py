"""Runs and models as tables: parameters, metrics, dictionaries, stages.

``<path>/runs`` has one row per training run, ``<path>/models/<run_id>`` its
fitted model, ``<path>/registry`` one row per registration or stage change (the
latest row of a version counts). Both tables are only appended to.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone
from urllib.parse import quote
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.roles import ColumnRoles
from tablewright.sources.staging import create_once, folder_exists

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("experiment", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("label_values", T.ArrayType(T.StringType())),
        T.StructField("class_weights", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("label_column", T.StringType()),
        T.StructField("id_columns", T.ArrayType(T.StringType())),
        T.StructField("categorical_columns", T.ArrayType(T.StringType())),
        T.StructField("numeric_columns", T.ArrayType(T.StringType())),
        T.StructField("training_schema", T.StringType()),
        T.StructField("model_path", T.StringType()),
    ]
)

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("stage", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("changed_at", T.TimestampType()),
    ]
)

# The stage of a version before it is promoted, and the stage
# that scoring loads unless told otherwise.
NO_STAGE = "None"
PRODUCTION = "Production"


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


class RunStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def runs(self) -> DataFrame:
        return self._table("runs", RUN_SCHEMA)

    def registry(self) -> DataFrame:
        return self._table("registry", REGISTRY_SCHEMA)

    def model_path(self, run_id: str) -> str:
        return f"{self.path}/models/{run_id}"

    def sample_path(self, run_id: str) -> str:
        return f"{self.path}/samples/{run_id}"

    def log_run(
        self,
        experiment: str,
        run_name: str | None = None,
        params: dict | None = None,
        tags: dict | None = None,
        metrics: dict[str, float] | None = None,
        label_values: tuple[str, ...] = (),
        class_weights: dict[str, float] | None = None,
        roles: ColumnRoles | None = None,
        training_schema: T.StructType | None = None,
        model: PipelineModel | None = None,
        run_id: str | None = None,
    ) -> str:
        """Save the model, if any, then append the run; returns the run id."""
        run_id = run_id or uuid4().hex
        if model is not None:
            model.write().overwrite().save(self.model_path(run_id))
        self._append(
            "runs",
            RUN_SCHEMA,
            {
                "run_id": run_id,
                "experiment": experiment,
                "run_name": run_name,
                "finished_at": now(),
                "params": {k: str(v) for k, v in (params or {}).items()},
                "tags": {k: str(v) for k, v in (tags or {}).items()},
                "metrics": {k: float(v) for k, v in (metrics or {}).items()},
                "label_values": list(label_values),
                "class_weights": class_weights,
                "label_column": roles and roles.label,
                "id_columns": roles and list(roles.ids),
                "categorical_columns": roles and list(roles.categorical),
                "numeric_columns": roles and list(roles.numeric),
                "training_schema": training_schema and training_schema.json(),
                "model_path": self.model_path(run_id) if model is not None else None,
            },
        )
        return run_id

    def best_run(self, metric: str, experiment: str | None = None) -> Row:
        """The run with the highest metric; equal ones by name and id."""
        runs = self.runs()
        if experiment is not None:
            runs = runs.filter(F.col("experiment") == experiment)
        ranked = runs.filter(F.col("metrics")[metric].isNotNull()).orderBy(
            F.desc(F.col("metrics")[metric]), "run_name", "run_id"
        )
        best = ranked.first()
        if best is None:
            raise ValueError(f"No run with metric '{metric}'.")
        return best

    def register(self, name: str, run_id: str, stage: str = NO_STAGE) -> int:
        """Add a run's model as the next version of a name.

        A version belongs to the training that creates its claim file, which only one can, so
        two that register at once get two versions. A training that ends between its claim and
        its row leaves a gap in the numbers.
        """
        taken = self.registry().filter(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (taken or 0) + 1
        while not create_once(self.spark, self.claim_path(name, version), run_id):
            version += 1
        self._append_version(name, version, stage, run_id)
        return version

    def claim_path(self, name: str, version: int) -> str:
        return f"{self.path}/claims/{quote(name, safe='')}/{version}"

    def promote(self, name: str, version: int, stage: str = PRODUCTION) -> None:
        known = self.versions(name).filter(F.col("version") == version).first()
        if known is None:
            raise ValueError(f"Model '{name}' has no version {version}.")
        self._append_version(name, version, stage, known.run_id)

    def versions(self, name: str) -> DataFrame:
        """Each version with its current stage."""
        return (
            self.registry()
            .filter(F.col("name") == name)
            .groupBy("version", "run_id")
            .agg(F.max_by("stage", "changed_at").alias("stage"))
            .select("version", "stage", "run_id")
        )

    def find(self, name: str, stage: str = PRODUCTION) -> Row:
        """The run behind the newest version in a stage."""
        current = self.versions(name).filter(F.col("stage") == stage).orderBy(F.desc("version")).first()
        if current is None:
            raise ValueError(f"Model '{name}' has no version in stage '{stage}'.")
        return self.run(current.run_id)

    def run(self, run_id: str) -> Row:
        found = self.runs().filter(F.col("run_id") == run_id).first()
        if found is None:
            raise ValueError(f"No run '{run_id}'.")
        return found

    def load(self, name: str, stage: str = PRODUCTION) -> tuple[PipelineModel, Row]:
        found = self.find(name, stage)
        return PipelineModel.load(found.model_path), found

    def _append_version(self, name: str, version: int, stage: str, run_id: str) -> None:
        self._append(
            "registry",
            REGISTRY_SCHEMA,
            {
                "name": name,
                "version": version,
                "stage": stage,
                "run_id": run_id,
                "changed_at": now(),
            },
        )

    def _append(self, table: str, schema: T.StructType, row: dict) -> None:
        record = F.from_json(F.lit(json.dumps(row)), schema)
        rows = self.spark.range(0, 1, 1, 1).select(record.alias("record")).select("record.*")
        # A folder for each row: writers in one folder would clear away each other's open files.
        rows.write.parquet(f"{self.path}/{table}/{uuid4().hex}")

    def _table(self, table: str, schema: T.StructType) -> DataFrame:
        path = f"{self.path}/{table}"
        if not folder_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def run_roles(run: Row) -> ColumnRoles:
    return ColumnRoles(
        label=run.label_column,
        ids=tuple(run.id_columns),
        categorical=tuple(run.categorical_columns),
        numeric=tuple(run.numeric_columns),
    )


def run_schema(run: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(run.training_schema))
