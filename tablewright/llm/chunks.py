"""Documents staged as chunks of about two megabytes, bucketed by chunk.

Some operators pass over the text several times and get word back in between about
places in it. The text is dealt out once: chunk rows are written as a bucketed table
in the shared folder, so a later join of small messages to their chunk shuffles the
messages alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.staging import drop_staged, new_path

CHUNK_BYTES = 2 << 20
# A chunk's number leaves 16 bits free, for the place of a document in it.
CHUNK_DOCS = 1 << 16
SCHEMA = "chunk long, ids array<long>, sizes array<long>, n_bytes long, body binary, rest binary"
BODY = ("chunk", "ids", "sizes", "n_bytes", "body")


def pack(
    batches: Iterator[pa.RecordBatch], chunk_bytes: int, first: int
) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, others) as chunk rows; a text longer than a chunk is one by itself."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=1).compress
    ids, texts, size, number = [], [], 0, first
    others: list[pa.RecordBatch] = []

    def row() -> pa.RecordBatch:
        body, rest = b"".join(texts), None
        if others and others[0].num_columns:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, others[0].schema) as stream:
                for some in others:
                    stream.write_batch(some)
            rest = compress(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([len(body)], pa.int64()),
                pa.array([compress(body)], pa.binary()),
                pa.array([rest], pa.binary()),
            ],
            names=[*BODY, "rest"],
        )

    for batch in batches:
        other, begun = batch.select(range(2, batch.num_columns)), 0
        for i, (key, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            if texts and (size + len(data) > chunk_bytes or len(texts) == CHUNK_DOCS):
                others.append(other.slice(begun, i - begun))
                yield row()
                ids, texts, size, number = [], [], 0, number + 1
                others, begun = [], i
            ids.append(key.as_py())
            texts.append(data)
            size += len(data)
        others.append(other.slice(begun))
    if texts:
        yield row()


class Chunk:
    """One chunk in a task: the ids (None where null) and the texts of its documents."""

    def __init__(self, row: dict):
        import zstandard

        self.number = row["chunk"]
        self.ids = row["ids"]
        # A null id sorts after all others.
        self.ranks = np.array([2**63 - 1 if i is None else i for i in row["ids"]], np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        self.edges = np.concatenate(([0], np.cumsum(self.sizes)))
        self.body = zstandard.ZstdDecompressor().decompress(
            row["body"], max_output_size=max(1, row["n_bytes"])
        )

    def rest(self, row: dict) -> pa.Table:
        """The other columns of the documents."""
        import zstandard

        plain = zstandard.ZstdDecompressor().decompressobj().decompress(row["rest"])
        return pa.ipc.open_stream(plain).read_all()

    def texts(self) -> list[bytes]:
        edges = self.edges.tolist()
        return [self.body[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def chunks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, dict]]:
    """Every chunk row of a task with the other columns of its row."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            yield Chunk(row), row


class Chunks:
    """``docs`` as a staged chunk table; with ``whole`` its rows keep all their columns."""

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        chunk_bytes: int = CHUNK_BYTES,
        whole: bool = False,
    ):
        spark = docs.sparkSession
        self.spark: SparkSession = spark
        self.path = new_path(spark, "chunks")
        self.table = f"tablewright_chunks_{uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

        def packed(batches):
            return pack(batches, chunk_bytes, TaskContext.get().partitionId() << 22)

        (
            docs.select(
                F.col(id_col).cast("long").alias("_chunk_id"),
                F.col(text_col).alias("_chunk_text"),
                *([c for c in docs.columns if c != text_col] if whole else []),
            )
            .mapInArrow(packed, SCHEMA)
            .repartition(buckets, "chunk")
            .write.format("parquet")
            .option("path", self.path)
            .option("compression", "uncompressed")
            .bucketBy(buckets, "chunk")
            .saveAsTable(self.table)
        )
        total = self.scan().agg(F.sum("n_bytes").alias("n")).first()
        self.n_bytes: int = total.n or 0

    def scan(self) -> DataFrame:
        return self.spark.table(self.table)

    def with_messages(self, messages: DataFrame) -> DataFrame:
        """Chunk rows beside what their messages (one row per chunk) say, or nulls."""
        return self.scan().join(messages.hint("shuffle_hash"), "chunk", "left")

    def groups(self, bytes_each: int = 8 << 20, least: int = 64) -> int:
        """So many exchange groups that each holds a bounded share of the input."""
        return max(least, -(-self.n_bytes // bytes_each))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        drop_staged(self.spark, self.path)
