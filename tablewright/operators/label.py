"""Label dictionary, label index and class weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import named
from tablewright.operators.clean import drop_null_label
from tablewright.operators.ranking import ranked
from tablewright.roles import CLASS_WEIGHT, INDEXED_LABEL

# Fixed value: the number of classes of the learner.
TWO_CLASSES = 2

# Labels that a dictionary on the driver may have.
MOST_LABELS = 100_000


@dataclass(frozen=True)
class LabelDictionary:
    """Label texts in index order with their row counts."""

    values: tuple[str, ...]
    counts: tuple[int, ...]

    def weights(self) -> dict[float, float]:
        """Balanced weight of each class: rows / (classes x rows of the class)."""
        total = sum(self.counts)
        classes = len(self.counts)
        return {float(i): total / (classes * n) for i, n in enumerate(self.counts)}

    def as_text_weights(self) -> dict[str, float]:
        return {str(index): weight for index, weight in self.weights().items()}


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(named(label).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def label_table(df: DataFrame, label: str) -> DataFrame:
    """(value, n, idx, class_weight): the dictionary as a table, for any number of labels.

    Labels are numbered by falling frequency, equal ones by text, range by range: labels that
    all occur once are no larger a task than others. The table is staged in the shared folder.
    """
    counts = class_counts(drop_null_label(df, label), label)
    placed, path = ranked(counts, [F.desc("n"), F.asc("value")])
    total = df.sparkSession.read.parquet(path).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")
    ).first()
    return placed.select(
        "value",
        "n",
        F.col("place").alias("idx"),
        (F.lit(total.rows) / (total.classes * F.col("n"))).alias("class_weight"),
    )


def join_label_index(
    df: DataFrame, label: str, labels: DataFrame, output: str = INDEXED_LABEL
) -> DataFrame:
    """Class numbers from a ``label_table``; a label outside it, or none, gives null."""
    known = labels.select(F.col("value").alias("__label_text__"), F.col("idx").cast("double").alias(output))
    same = named(label).cast("string") == F.col("__label_text__")
    return df.join(known, same, "left").drop("__label_text__")


def label_range(label: str) -> list[Column]:
    """The least and the greatest label, as an observation can keep them in fixed memory."""
    text = named(label).cast("string")
    return [F.min(text).alias("least_label"), F.max(text).alias("greatest_label")]


def two_labels(
    df: DataFrame, label: str, least: str, greatest: str
) -> tuple[LabelDictionary, int]:
    """The dictionary of a label of at most two values, and the rows with any other value.

    One aggregate of three numbers: however many values there are, none is brought to the driver.
    """
    text = named(label).cast("string")
    values = list(dict.fromkeys([least, greatest]))
    found = df.agg(
        F.count(text).alias("rows"), *[F.count_if(text == v).alias(f"n{i}") for i, v in enumerate(values)]
    ).first()
    counts = [(v, found[f"n{i}"]) for i, v in enumerate(values) if found[f"n{i}"]]
    ordered = in_order(counts, label, None)
    return ordered, found.rows - sum(ordered.counts)


def in_order(counts: list[tuple[str, int]], label: str, positive: str | None) -> LabelDictionary:
    """Labels by falling frequency, equal ones by text.

    ``positive`` moves one label to the last index, so that with two classes
    ``1.0`` always means that label, whatever its frequency.
    """
    ranked_counts = sorted(counts, key=lambda c: (-c[1], c[0]))
    if positive is not None:
        if positive not in [value for value, _ in counts]:
            raise ValueError(f"Positive label '{positive}' does not occur in '{label}'.")
        ranked_counts.sort(key=lambda c: c[0] == positive)
    return LabelDictionary(
        values=tuple(value for value, _ in ranked_counts), counts=tuple(n for _, n in ranked_counts)
    )


def label_dictionary(
    df: DataFrame, label: str, positive: str | None = None, most: int = MOST_LABELS
) -> LabelDictionary:
    """The dictionary on the driver; more than ``most`` labels are refused, a table holds them.

    Order and ``positive`` are as in ``in_order``.
    """
    counted = class_counts(drop_null_label(df, label), label).limit(most + 1).collect()
    if len(counted) > most:
        raise ValueError(f"'{label}' has more than {most} labels; label_table takes any number.")
    return in_order([(row.value, row.n) for row in counted], label, positive)


def index_label(
    df: DataFrame, label: str, dictionary: LabelDictionary, output: str = INDEXED_LABEL
) -> DataFrame:
    """Add the class number; a label outside the dictionary fails the job."""
    text = "label_text"
    indexer = StringIndexerModel.from_labels(
        list(dictionary.values), inputCol=text, outputCol=output, handleInvalid="error"
    )
    return indexer.transform(df.withColumn(text, named(label).cast("string"))).drop(text)


def add_class_weight(
    df: DataFrame, weights: dict[float, float], index: str = INDEXED_LABEL, output: str = CLASS_WEIGHT
) -> DataFrame:
    """Look the weight up in a literal map; an unknown class gives null."""
    pairs = [F.lit(part) for pair in weights.items() for part in pair]
    return df.withColumn(output, F.create_map(*pairs)[named(index)])
