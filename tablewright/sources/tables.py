"""Table sources.

A CSV row is malformed when its number of fields or one of its values does not
fit the schema. Spark notices that only for the columns a query reads, so the
same file would have another row count in every query. Two ways out are used:

* ``open_table`` parses all columns once into a staged Parquet table and keeps
  a mark on malformed rows; the many jobs of a training read that table.
* ``open_text_table`` reads all fields as text with column pruning off. Text
  always fits, and the number of fields is checked in every row, so one pass is
  enough; the malformed rows are counted on the way by an observation.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tablewright.functions.columns import named
from tablewright.roles import ColumnRoles, clean_name
from tablewright.sources.staging import drop_staged, stage

# The text that means null in a CSV file, the column that holds
# the text of a malformed row.
NULL_TEXT = "NA"
MALFORMED = "__malformed_row__"

MALFORMED_COUNT = "malformed"


def csv_reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.options(header=True, nullValue=NULL_TEXT)


def header_names(spark: SparkSession, path: str | list[str]) -> list[str | None]:
    """The fields of one header line, as they stand in the file."""
    first = spark.read.csv(path).first()
    return list(first) if first else []


@dataclass(frozen=True)
class Files:
    """CSV files with one header."""

    header: list[str | None]
    paths: str | list[str]


# First lines that are asked for at the same time.
HEADS_AT_ONCE = 16


def by_header(spark: SparkSession, path: str | list[str]) -> list[Files]:
    """The files of a path by their header, the header of the first file first.

    Looks at the first line of each file. Headers with other columns than the first one, or with
    fields that can't tell columns apart, are refused; the error names a file of them.
    """
    paths = sorted(spark.read.text(path).inputFiles())
    if len(paths) < 2:
        return [Files(header_names(spark, path), path)]

    def head(file: str) -> str | None:
        first = spark.read.text(file).first()
        return first.value if first else None

    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        heads = dict(zip(paths, pool.map(head, paths)))
    same: dict[str, list[str]] = {}
    for file, line in heads.items():
        if line is not None:
            same.setdefault(line, []).append(file)
    if len(same) < 2:
        return [Files(header_names(spark, path), path)]
    groups = [Files(header_names(spark, files[0]), files) for files in same.values()]
    first = groups[0].header
    for group in groups[1:]:
        unlike = set(first) ^ set(group.header) or (len(set(first)) < len(first) and first != group.header)
        if unlike or len(group.header) != len(first):
            raise ValueError(
                f"The header of {group.paths[0]} has the columns {group.header}, that of "
                f"{groups[0].paths[0]} has {first}; files are read together only with the same columns."
            )
    return groups


def in_file_order(schema: T.StructType, header: Sequence[str | None]) -> T.StructType:
    """The caller's fields in the order of the header, if it has just these names."""
    by_name = {f.name: f for f in schema.fields}
    if set(by_name) == set(header) and len(header) == len(by_name):
        return T.StructType([by_name[name] for name in header])
    return schema


def checked_by_name(
    reader: DataFrameReader, schema: T.StructType, header: Sequence[str | None]
) -> DataFrameReader:
    """Refuse files whose header has the columns in another order than the schema.

    The reader would give their values to the wrong columns. Headers that can't be column
    names as they stand (empty or repeated fields) are read by position.
    """
    return reader.option("enforceSchema", list(header) != schema.names)


Reader = TypeVar("Reader", DataFrameReader, DataStreamReader)


def marking(reader: Reader, schema: T.StructType) -> Reader:
    """Keep malformed rows and mark them with their text."""
    marked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    return reader.schema(marked).options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)


def without_malformed(marked: DataFrame, seen: Observation | str) -> DataFrame:
    """Leave marked rows out and let the observation count them on the way."""
    mark = named(MALFORMED)
    counted = marked.observe(seen, F.count_if(mark.isNotNull()).alias(MALFORMED_COUNT))
    return counted.filter(mark.isNull()).drop(MALFORMED)


@dataclass(frozen=True)
class OpenTable:
    """Rows of a source that have the same content in every query."""

    rows: DataFrame
    staged: str | None = None

    @property
    def malformed(self) -> int:
        """Rows left out because they do not fit the schema."""
        if self.staged is None:
            return 0
        table = self.rows.sparkSession.read.parquet(self.staged)
        return table.filter(named(MALFORMED).isNotNull()).count()

    def drop(self) -> None:
        if self.staged is not None:
            drop_staged(self.rows.sparkSession, self.staged)


def open_table(
    spark: SparkSession,
    source: str | DataFrame,
    format: str = "csv",
    schema: T.StructType | None = None,
    on_malformed: str = "drop",
) -> OpenTable:
    """Open a CSV or Parquet path (any URI Spark reads) or take a DataFrame.

    Types are inferred from the whole CSV file unless ``schema`` is given, which
    saves one scan of it; its columns are found by name, in any order. Files of a folder
    may have the same columns in different orders. ``on_malformed='fail'`` raises instead
    of dropping.
    """
    if isinstance(source, DataFrame):
        return OpenTable(source)
    if format == "parquet":
        return OpenTable(spark.read.parquet(source))
    if format != "csv":
        raise ValueError(f"Unknown format '{format}', use csv or parquet.")

    groups = by_header(spark, source)
    wanted = schema.names if schema else None
    if schema is None:
        inferring = csv_reader(spark).option("inferSchema", True)
        schema = common_schema([inferring.csv(files.paths).schema for files in groups])
    if not schema.fields:
        raise ValueError(f"No columns in {source}")
    schema = in_file_order(schema, groups[0].header)
    parsed = marked_rows(spark, groups, schema)
    # Staged by position: header texts need not be valid or distinct as column names.
    plain = [f"c{i}" for i in range(len(schema.fields))]
    path = stage(parsed.toDF(*plain, MALFORMED), "csv")
    kept = spark.read.parquet(path).filter(named(MALFORMED).isNull()).select(*plain)
    kept = kept.toDF(*schema.names)
    if wanted and wanted != schema.names:
        kept = kept.select(*map(named, wanted))
    table = OpenTable(kept, path)
    if on_malformed == "fail" and (count := table.malformed):
        table.drop()
        raise ValueError(f"{count} malformed rows in {source}")
    return table


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """The columns of the first schema, with types that hold what the others have of them."""
    if len(schemas) == 1:
        return schemas[0]
    return T.StructType(
        [T.StructField(f.name, reduce(wider, [s[f.name].dataType for s in schemas])) for f in schemas[0].fields]
    )


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of both; whole numbers within larger ones or doubles, all else as text."""
    if a == b:
        return a
    order = [T.IntegerType(), T.LongType(), T.DoubleType()]
    if a in order and b in order:
        return order[max(order.index(a), order.index(b))]
    dates = [T.DateType(), T.TimestampType()]
    return T.TimestampType() if a in dates and b in dates else T.StringType()


def marked_rows(
    spark: SparkSession, groups: list[Files], schema: T.StructType, pruning: bool = True
) -> DataFrame:
    """All files' rows in the order of ``schema``, with a mark: one scan for each header."""
    scans = []
    for files in groups:
        own = in_file_order(schema, files.header)
        reader = marking(csv_reader(spark).option("columnPruning", pruning), own)
        scan = checked_by_name(reader, own, files.header).csv(files.paths)
        scans.append(scan if own == schema else scan.select(*map(named, [*schema.names, MALFORMED])))
    return reduce(DataFrame.union, scans)


def marked_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All fields of CSV files as text, malformed rows marked, in one pass and without inference."""
    groups = by_header(spark, path)
    schema = csv_reader(spark).csv(groups[0].paths).schema
    return marked_rows(spark, groups, schema, pruning=False)


def open_text_table(
    spark: SparkSession, path: str | list[str], on_malformed: str = "drop"
) -> tuple[DataFrame, Observation | None]:
    """All fields of a CSV path as text, in one pass and without inference.

    The observation holds the number of malformed rows once the rows have been
    written; with ``on_malformed='fail'`` the first such row ends the job.
    """
    text = marked_text(spark, path)
    if on_malformed == "fail":
        return failing_on_malformed(text), None
    seen = Observation()
    return without_malformed(text, seen), seen


def failing_on_malformed(marked: DataFrame) -> DataFrame:
    mark = named(MALFORMED)
    fine = F.when(mark.isNull(), True).otherwise(
        F.raise_error(F.concat(F.lit("Malformed row: "), mark)).cast("boolean")
    )
    return marked.filter(fine).drop(MALFORMED)


def conform(df: DataFrame, training: T.StructType, roles: ColumnRoles) -> DataFrame:
    """Give feature columns the types they had in training.

    A category that was read as a date or a whole number then has the same text
    again, and a boolean number the same 1.0 or 0.0. What does not fit is null.
    """
    known = {clean_name(f.name): f.dataType for f in training.fields}

    def retyped(field: T.StructField) -> str | None:
        wanted = known.get(field.name)
        if wanted is None or wanted == field.dataType or is_nested(wanted) or is_nested(field.dataType):
            return None
        if field.name in roles.categorical and not isinstance(wanted, T.StringType):
            return wanted.simpleString()
        if field.name in roles.numeric and isinstance(wanted, T.BooleanType):
            return wanted.simpleString()
        return None

    types = {f.name: retyped(f) for f in df.schema.fields}
    return df.select(
        *[
            named(c).try_cast(wanted).alias(c) if wanted else named(c)
            for c, wanted in types.items()
        ]
    )


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType))


def request_rows(
    df: DataFrame, n: int = 1, order_by: Sequence[str] = (), drop: Sequence[str] = ()
) -> DataFrame:
    """The first n rows by ``order_by`` (or by all columns), without the named ones."""
    first = df.orderBy(*map(named, order_by or df.columns)).limit(n)
    return first.drop(*[c for c in drop if c in df.columns])


# Fixed value: the key of a request document that holds columns and rows apart.
SPLIT_KEY = "dataframe_split"


def to_requests(df: DataFrame) -> DataFrame:
    """Each row as one JSON record."""
    record = F.struct(*map(named, df.columns))
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def well_formed(
    marked: DataFrame, seen: Observation | str | None, on_malformed: str
) -> DataFrame:
    if on_malformed == "fail":
        return failing_on_malformed(marked)
    if seen is None:
        return marked.filter(named(MALFORMED).isNull()).drop(MALFORMED)
    return without_malformed(marked, seen)


def mark_requests(requests: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON records as columns, with a mark on broken ones."""
    marked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    row = F.from_json("value", marked, {"columnNameOfCorruptRecord": MALFORMED})
    whole = requests.select("value", row.alias("row"))
    mark = F.when(F.col("row").isNull(), F.coalesce("value", F.lit(""))).otherwise(
        F.col("row").getField(MALFORMED)
    )
    fields = [F.col("row").getField(f.name).alias(f.name) for f in schema.fields]
    return whole.select(*fields, mark.alias(MALFORMED))


def from_requests(
    requests: DataFrame,
    schema: T.StructType,
    seen: Observation | str | None = None,
    on_malformed: str = "drop",
) -> DataFrame:
    """JSON records back to columns; works on a stream of records as well.

    A record that is broken, or has a value of another type, is left out; ``seen`` counts
    these on the way. ``on_malformed='fail'`` ends the job with the first one.
    """
    return well_formed(mark_requests(requests, schema), seen, on_malformed)


def to_split_requests(df: DataFrame) -> DataFrame:
    """Each row as one document: ``{"dataframe_split": {"index", "columns", "data"}}``."""
    cells = F.array(*[named(c).cast("variant") for c in df.columns])
    table = F.struct(
        F.array(F.lit(0)).alias("index"),
        F.array(*map(F.lit, df.columns)).alias("columns"),
        F.array(cells).alias("data"),
    )
    document = F.struct(table.alias(SPLIT_KEY))
    return df.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))


def to_split_request(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows in one document, numbered from 0 under ``index``.

    n is what a caller sends at once; the document is made in one task.
    """
    first = request_rows(df, n, order_by)
    order = F.struct(*map(named, order_by or df.columns))
    cells = F.array(*[named(c).cast("variant") for c in df.columns])
    place = F.row_number().over(Window.orderBy(order)) - 1
    listed = first.select(place.alias("at"), cells.alias("cells")).agg(
        F.collect_list(F.struct("at", "cells")).alias("rows")
    )
    # Collected in the order of the window; variants have no order of their own.
    table = F.struct(
        F.transform("rows", lambda r: r["at"]).alias("index"),
        F.array(*map(F.lit, df.columns)).alias("columns"),
        F.transform("rows", lambda r: r["cells"]).alias("data"),
    )
    document = F.struct(table.alias(SPLIT_KEY))
    return listed.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))


def mark_split_requests(requests: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of such documents, with a mark on broken ones."""
    shape = f"{SPLIT_KEY} struct<columns array<string>, data array<array<variant>>>"
    table = F.from_json("value", shape).getField(SPLIT_KEY)
    rows = requests.select("value", table.alias("t")).select(
        "value", "t.columns", F.explode_outer("t.data").alias("cells")
    )
    fits = F.size("cells") == F.size("columns")
    mark = F.when(F.coalesce(fits, F.lit(False)), None).otherwise(F.coalesce("value", F.lit("")))

    def cell(name: str):
        # Places count from 1; 0 stands for a column that isn't there.
        place = F.nullif(F.array_position("columns", name), F.lit(0))
        return F.try_element_at("cells", place.cast("int"))

    fields = [
        F.try_variant_get(cell(f.name), "$", f.dataType.simpleString()).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*fields, mark.alias(MALFORMED))


def from_split_requests(
    requests: DataFrame,
    schema: T.StructType,
    seen: Observation | str | None = None,
    on_malformed: str = "drop",
) -> DataFrame:
    """Rows of such documents, any number per document, in any column order.

    Absent columns and values of another type are null. A broken document, one without
    columns or data, and a row with another number of cells than there are columns are left
    out as one malformed row each; ``seen`` and ``on_malformed`` are as in ``from_requests``.
    """
    return well_formed(mark_split_requests(requests, schema), seen, on_malformed)
