"""Token-id output as ORC (operator 6).

``write_token_orc`` encodes whole texts and writes one row per document, in
ascending id order, to ORC files: the id array is stored with ORC's integer
run-length encoding, stripes carry row indexes, and the document id column has
Bloom filters.  Files follow one another in id order (range partitioning, one
file for each range), so token positions are per-file running sums plus one
offset a file.  Readers get stripe-parallel scans from Spark, and a filter on
the document id prunes files, stripes and row groups by their statistics.

Defined cases: null or empty text is a document of the end id alone; a null
document id sorts first; repeated ids stay separate rows, ordered by a hash of
their text; an empty table gives empty files; other columns are not written.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StructField, StructType)

from ..session import scratch_path
from .common import BATCH_ROWS, chunks, table
from .tokens import memo_for

_ORC = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
}


def token_schema(id_type) -> StructType:
    return StructType([
        StructField("part", IntegerType()), StructField("doc_id", id_type),
        StructField("part_start", LongType()), StructField("n_tokens", LongType()),
        StructField("tokens", ArrayType(IntegerType(), False)),
    ])


def _encoder(tokenizer: str, end_id: int):
    def encode(batches):
        memo = memo_for(tokenizer)
        part, at = TaskContext.get().partitionId(), 0
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            ids_in, texts = batch.column(0), batch.column(1)
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                first = rows[0]
                starts, sizes, blobs = [], [], []
                for i in rows:
                    blob = memo.ids_bytes(texts[i].as_py() or "") + end
                    blobs.append(blob)
                    starts.append(at)
                    sizes.append(len(blob) // 4)
                    at += sizes[-1]
                values = pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(blobs))])
                bounds = pa.array([s - starts[0] for s in starts] + [at - starts[0]], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), ids_in.slice(first, len(rows)),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(bounds, values)],
                    names=["part", "doc_id", "part_start", "n_tokens", "tokens"])
    return encode


def write_token_orc(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                    text_col: str = "text", stripe_bytes: int = 16 << 20, index_stride: int = 1000) -> StructType:
    """Encode ``docs`` and write the ORC files; returns their schema."""
    schema = token_schema(docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = (rows.withColumn("_h", F.xxhash64("text")).repartitionByRange("doc_id", "_h")
               .sortWithinPartitions("doc_id", "_h").drop("_h"))
    (ordered.mapInArrow(_encoder(tokenizer, end_id), schema)
     .write.options(**_ORC)
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.row.index.stride", str(index_stride))
     .orc(path))
    return schema


def read_token_orc(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All documents; column pruning and id filters reach the ORC readers."""
    return spark.read.schema(schema).orc(path)


def documents_by_id(spark: SparkSession, path: str, schema: StructType, ids: list) -> DataFrame:
    """Rows of a few ids: the predicate is pushed to file, stripe and row-group statistics and Bloom filters."""
    return read_token_orc(spark, path, schema).where(F.col("doc_id").isin(list(ids)))


def part_offsets(files: DataFrame) -> DataFrame:
    """Ids of all files before each file; one row a file."""
    per_file = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("part_offset"))


def _digests(batches):
    for batch in batches:
        tokens = batch.column(batch.schema.get_field_index("tokens"))
        bounds = tokens.offsets.to_numpy()
        flat = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
        sizes = (bounds[1:] - bounds[:-1]).astype("int64")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes), pa.array(crc, pa.int64())],
            names=["part", "doc_id", "part_start", "n_tokens", "ids_crc32"])


def token_digests(files: DataFrame) -> DataFrame:
    """Position, length and checksum of every document, from the files alone."""
    schema = StructType([*files.schema.fields[:3], StructField("n_tokens", LongType()),
                         StructField("ids_crc32", LongType())])
    read = files.select("part", "doc_id", "part_start", "tokens").mapInArrow(_digests, schema)
    return (read.join(part_offsets(files), "part")
            .select("doc_id", (F.col("part_start") + F.col("part_offset")).alias("start"),
                    "n_tokens", "ids_crc32"))


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids as ORC and read them back."""
    import public_tokenizers

    path = scratch_path(spark, "token-orc")
    schema = write_token_orc(table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_digests(read_token_orc(spark, path, schema))


QUERIES = {"op6_token_orc": op6_token_orc}
SQL: dict = {}
