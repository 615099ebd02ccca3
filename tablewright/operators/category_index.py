"""Index of categories from a dictionary table instead of an array on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.columns import named
from tablewright.sources.staging import drop_staged

# So many most frequent values of a column are looked up under several keys, so many each: a value
# of a third of all rows is then joined by many tasks.
HOT_VALUES = 32
SALTS = 64


class CategoryIndex(Transformer, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """Adds to each input column the place of its value in a dictionary of any size.

    ``path`` holds (position, value, idx) with the column's place among the input columns; column
    ``c`` has ``sizes[c]`` values. An unseen or null value gets the index after the last one, as
    the built-in stage does with ``handleInvalid='keep'``. The dictionary is joined: Spark sends a
    small one to all tasks and shuffles a large one, with frequent and null values spread over
    several keys. Saving a model copies the table into it; a fitted stage's own table lies in the
    shared folder until ``drop``.
    """

    def __init__(
        self,
        columns: Sequence[str] = (),
        outputs: Sequence[str] = (),
        sizes: Sequence[int] = (),
        path: str | None = None,
    ):
        super().__init__()
        self._set(inputCols=list(columns), outputCols=list(outputs))
        self.sizes = list(sizes)
        self.path = path

    def dictionary(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def drop(self, spark: SparkSession) -> None:
        drop_staged(spark, self.path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        table = self.dictionary(spark)
        hot = (
            table.where(F.col("idx") < HOT_VALUES)
            .select("position", "value")
            .collect()
        )
        names = dataset.columns
        for i, (column, output) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            frequent = [row.value for row in hot if row.position == i]
            own = table.where(F.col("position") == i)
            salts = F.when(F.col("idx") < HOT_VALUES, F.sequence(F.lit(0), F.lit(SALTS - 1)))
            known = own.select(
                F.col("value").alias("__value__"),
                F.col("idx").alias("__idx__"),
                F.explode(F.coalesce(salts, F.array(F.lit(0)))).alias("__salt__"),
            )
            text = named(column).cast("string")
            spread = text.isNull() | text.isin(frequent)
            dealt = dataset.withColumns(
                {
                    "__text__": text,
                    "__key__": F.when(spread, F.spark_partition_id() % SALTS).otherwise(0),
                }
            )
            same = (F.col("__text__") == F.col("__value__")) & (F.col("__key__") == F.col("__salt__"))
            joined = dealt.join(known, same, "left")
            index = F.coalesce("__idx__", F.lit(float(self.sizes[i])))
            dataset = joined.select(*map(named, names), index.alias(output))
            names = [*names, output]
        return dataset

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: CategoryIndex):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        stage = self.instance
        DefaultParamsWriter.saveMetadata(stage, path, spark, extraMetadata={"sizes": stage.sizes})
        stage.dictionary(spark).write.parquet(f"{path}/dictionary")


class _Reader(MLReader):
    def __init__(self, cls: type[CategoryIndex]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryIndex:
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        stage = self.cls(sizes=metadata["sizes"], path=f"{path}/dictionary")
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
