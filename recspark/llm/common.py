"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The six ASCII white-space characters that end a word (fixed values).
ASCII_SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Rows handed to one Arrow batch by the Python stages.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later jobs read the files, whichever executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none), as an array."""
    body = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(F.length(body) > 0, F.split(body, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The same words in Python, as UTF-8; ``bytes`` splits at, and lowers, ASCII alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class TokenCodes(dict):
    """Memo of 64-bit codes of tokens: one hash for each token a worker has met.

    The memo is emptied when it holds ``limit`` tokens, so a worker's memory
    does not grow with the corpus; codes do not depend on the memo.
    """

    def __init__(self, limit: int = 400_000):
        super().__init__()
        import xxhash
        self._hash = xxhash.xxh3_64_intdigest
        self._limit = limit

    def __missing__(self, token: str | bytes) -> int:
        raw = token if isinstance(token, bytes) else token.encode("utf-8", "surrogatepass")
        code = self._hash(raw)
        if len(self) >= self._limit:
            self.clear()
        self[token] = code
        return code

    def of(self, tokens: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


#: Odd multipliers of the rolling window codes (fixed values).
_MIX_A = np.uint64(0x9E3779B97F4A7C15)
_MIX_B = np.uint64(0xBF58476D1CE4E5B9)


def scramble(x: np.ndarray) -> np.ndarray:
    """Bijective mix of 64-bit codes (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_B
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_A
    return x ^ (x >> np.uint64(31))


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code for each window of ``width`` consecutive token codes."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * _MIX_A + codes[k:k + n]
    return scramble(out)


def small(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """``df`` to be sent to all workers if its rows are counted to be few, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def chunks(iterable, size: int):
    it = iter(iterable)
    while part := list(itertools.islice(it, size)):
        yield part


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema)], schema=schema)
