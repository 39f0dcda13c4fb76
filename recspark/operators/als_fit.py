"""Implicit ALS in packed blocks (M1): the fit behind ``als.fit_als``.

The problem of ``pyspark.ml.recommendation.ALS`` with implicit preferences: a row's
vector solves ``(Y'Y + reg n I + X' C X) x = X' b`` over the vectors ``X`` of what it
rated, confidence ``c = alpha |r|``, ``b = 1 + c`` and counted in ``n`` where ``r > 0``.

Each side is dealt once into blocks by a hash of the id; the ratings of a block
are one packed record.  A half step crosses the written factor records of one side
with the rating records of the other (as in ``block_cross``, the factors streamed):
a task holds its block's ratings and the vectors that these name, no more, and no
vector is shuffled, so neither disk nor shuffle grows with the blocks.  Blocks are
cut so that those vectors stay bounded.  Factors of earlier steps are removed.

All vectors are turned to the axes where ``Y'Y`` is diagonal.  There a row of few
ratings needs a system as large as its ratings and not as the rank; rows of equally
many ratings are solved together.  Rows of very many ratings add up their normal
equations while the factors pass and hold no vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, FloatType, IntegerType, LongType, StructField,
                               StructType)

from ..session import free_shuffles, removed, scratch_path

#: Numbers of the vectors that a block's ratings name, at most about (32 bits each), and ratings of a block.
BLOCK_NUMBERS = 64_000_000
BLOCK_RATINGS = 4_000_000
#: Ratings for which a further block is worth a task.
LEAST_RATINGS = 20_000
#: Rows of more ratings add up their normal equations instead of holding the vectors.
HOT = 4096
#: Numbers (64 bits) in one batch of systems.
BATCH = 1 << 21
#: Numbers (32 bits) in one record of factors.
RECORD = 1 << 20
#: Bytes of one batch of pairs on its way to a Python worker, about.
BATCH_BYTES = "16m"

_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_RATINGS = StructType([
    StructField("block", IntegerType()), StructField("hot", BooleanType()), StructField("named", IntegerType()),
    StructField("starts", ArrayType(LongType())),
    *[StructField(c, BinaryType()) for c in ("ids", "bounds", "need", "at", "vals")]])
_FACTORS = StructType([StructField("block", IntegerType()), *[StructField(c, BinaryType()) for c in ("ids", "vecs", "gram")]])
_ROWS = StructType([StructField("id", IntegerType()), StructField("features", ArrayType(FloatType()))])


def _arrow(schema: StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])


def _record(schema: pa.Schema, *values) -> pa.RecordBatch:
    values = [v.tobytes() if isinstance(v, np.ndarray) else v for v in values]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _pack_fn(others: int):
    """One record a block from rows (block, id, other block, other, value)."""
    schema = _arrow(_RATINGS)

    def fn(batches):
        parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if batch.num_rows]
        if not parts:
            return
        block, own, far, other, val = (np.concatenate(x) for x in zip(*parts))
        for b in np.unique(block):
            here = np.flatnonzero(block == b)
            # what the block needs, in the order in which the other side's blocks hold it
            key, at = np.unique((far[here].astype(np.int64) << 32) + (other[here].astype(np.int64) + (1 << 31)), return_inverse=True)
            order = np.lexsort((at, own[here]))
            ids, first = np.unique(own[here][order], return_index=True)
            bounds = np.append(first, len(here)).astype(np.int64)
            need = ((key & 0xFFFFFFFF) - (1 << 31)).astype(np.int32)
            starts = np.searchsorted(key >> 32, np.arange(others + 1)).tolist()
            yield _record(schema, int(b), bool(np.diff(bounds).max() > HOT), len(need), starts, ids.astype(np.int32), bounds, need,
                          at[order].astype(np.int32), val[here][order].astype(np.float32))
    return fn


def _first_fn(rank: int, seed: int):
    """Random unit vectors for the ids of each block."""
    schema = _arrow(_FACTORS)

    def fn(batches):
        for batch in batches:
            for b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.random.default_rng([seed, b]).normal(size=(len(ids) // 4, rank))
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
                yield from _factors(schema, b, np.frombuffer(ids, dtype=np.int32), x)
    return fn


def _factors(schema: pa.Schema, block: int, ids: np.ndarray, x: np.ndarray):
    """Records of a block's factors by ascending id; the first has the products of them all."""
    step = max(1, RECORD // x.shape[1])
    for first in range(0, len(ids), step):
        yield _record(schema, block, ids[first:first + step], x[first:first + step], None if first else _gram(x))


def _gram(x: np.ndarray) -> np.ndarray:
    total = np.zeros((x.shape[1], x.shape[1]))
    for first in range(0, len(x), 1 << 16):
        part = x[first:first + (1 << 16)].astype(np.float64)
        total += part.T @ part
    return total


def _of(column: pa.Array, i: int, dtype) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), dtype=dtype)


class _Block:
    """The ratings of one block while the other side's factors pass."""

    def __init__(self, named: int, rank: int, hot: bool):
        self.rank, self.hot = rank, hot
        self.vecs = None if hot else np.empty((named, rank), dtype=np.float32)
        self.ratings = None

    def load(self, ids, bounds, at, vals) -> None:
        self.ratings = tuple(np.array(x) for x in (ids, bounds, at, vals))
        _, bounds, at, vals = self.ratings
        size = np.diff(bounds)
        self.hot_rows = np.flatnonzero(size > HOT) if self.hot else np.empty(0, dtype=np.int64)
        self.slot = None
        if self.hot:
            few = np.repeat(size <= HOT, size)
            self.slot = np.full(int(at.max()) + 1, -1, dtype=np.int64)
            used = np.unique(at[few])
            self.slot[used] = np.arange(len(used))
            self.vecs = np.empty((len(used), self.rank), dtype=np.float32)
            self.sums = {int(j): [np.zeros((self.rank, self.rank)), np.zeros(self.rank)] for j in self.hot_rows}

    def meet(self, first: int, x: np.ndarray, alpha: float) -> None:
        """``x``: the turned vectors of the needed rows from ``first`` on."""
        if not self.hot:
            self.vecs[first:first + len(x)] = x
            return
        slot = self.slot[first:first + len(x)]
        self.vecs[slot[slot >= 0]] = x[:len(slot)][slot >= 0]
        _, bounds, at, vals = self.ratings
        for j, (left, right) in self.sums.items():
            a, b = bounds[j] + np.searchsorted(at[bounds[j]:bounds[j + 1]], [first, first + len(x)])
            for lo in range(int(a), int(b), 1 << 15):
                hi = min(int(b), lo + (1 << 15))
                part, r = x[at[lo:hi] - first].astype(np.float64), vals[lo:hi].astype(np.float64)
                c = alpha * np.abs(r)
                left += (part * c[:, None]).T @ part
                right += np.where(r > 0, 1.0 + c, 0.0) @ part

    def solved(self, axis: np.ndarray, turn: np.ndarray, reg: float, alpha: float) -> tuple[np.ndarray, np.ndarray]:
        """The block's ids and their vectors."""
        ids, bounds, at, vals = self.ratings
        size, k = np.diff(bounds), self.rank
        out = np.zeros((len(ids), k), dtype=np.float32)
        explicit = np.add.reduceat((vals > 0).astype(np.float64), bounds[:-1])
        lowest = 1e-12 * max(float(axis.max()), 1e-300)
        for j, (left, right) in getattr(self, "sums", {}).items():
            out[j] = turn @ np.linalg.solve(left + np.diag(np.maximum(axis + reg * explicit[j], lowest)), right)
        cold = np.flatnonzero(size <= HOT) if self.hot else np.arange(len(ids))
        cold = cold[np.argsort(size[cold], kind="stable")]
        cuts = np.flatnonzero(np.diff(size[cold], prepend=-1))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(cold))):
            m = int(size[cold[lo]])
            few = 5 * m <= 4 * k
            step = max(1, BATCH // (m * k + (m * m if few else k * k)))
            for first in range(lo, hi, step):
                rows = cold[first:min(hi, first + step)]
                cells = bounds[rows][:, None] + np.arange(m)
                which = at[cells] if self.slot is None else self.slot[at[cells]]
                x, r = self.vecs[which].astype(np.float64), vals[cells].astype(np.float64)
                c = alpha * np.abs(r)
                b = np.where(r > 0, 1.0 + c, 0.0)
                diagonal = np.maximum(axis + reg * explicit[rows][:, None], lowest)
                if few:             # (D + X'CX)^-1 X'b = D^-1 X' (C^-1 + X D^-1 X')^-1 C^-1 b
                    scaled = x / diagonal[:, None, :]
                    inner = scaled @ x.transpose(0, 2, 1)
                    back = np.divide(1.0, c, out=np.full(c.shape, 1e300), where=c > 0)
                    inner[:, np.arange(m), np.arange(m)] += back
                    y = np.linalg.solve(inner, np.where(c > 0, back * b, 0.0)[:, :, None])
                    found = scaled.transpose(0, 2, 1) @ y
                else:
                    left = (x * c[:, :, None]).transpose(0, 2, 1) @ x
                    left[:, np.arange(k), np.arange(k)] += diagonal
                    found = np.linalg.solve(left, (b[:, None, :] @ x).transpose(0, 2, 1))
                out[rows] = found[:, :, 0] @ turn.T
        return ids, out


def _solve_fn(rank: int, reg: float, alpha: float, turn: np.ndarray, axis: np.ndarray):
    schema = _arrow(_FACTORS)

    def fn(batches):
        blocks: dict[int, _Block] = {}
        turned = turn.astype(np.float32)
        for batch in batches:
            at = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                b = at["block"][i].as_py()
                if b not in blocks:
                    blocks[b] = _Block(at["named"][i].as_py(), rank, at["hot"][i].as_py())
                block = blocks[b]
                if block.ratings is None and at["at"][i].is_valid:
                    block.load(*(_of(at[c], i, t) for c, t in (("ids", np.int32), ("bounds", np.int64), ("at", np.int32), ("vals", np.float32))))
                need, ids = _of(at["need"], i, np.int32), _of(at["f_ids"], i, np.int32)
                lo, hi = np.searchsorted(need, ids[0]), np.searchsorted(need, ids[-1], "right")     # those of this record
                if lo < hi:
                    x = _of(at["f_vecs"], i, np.float32).reshape(-1, rank)
                    rows = np.searchsorted(ids, need[lo:hi])
                    block.meet(at["first"][i].as_py() + int(lo), (x if len(rows) == len(x) else x[rows]) @ turned, alpha)
        while blocks:
            b, block = blocks.popitem()
            yield from _factors(schema, b, *block.solved(axis, turn, reg, alpha))
    return fn


def _rows_fn(rank: int):
    schema = _arrow(_ROWS)

    def fn(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = _of(batch.column(0), i, np.int32), _of(batch.column(1), i, np.float32)
                for first in range(0, len(ids), 1 << 14):
                    part = ids[first:first + (1 << 14)]
                    vecs = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * rank),
                                                    pa.array(x[first * rank:(first + len(part)) * rank]))
                    yield pa.RecordBatch.from_arrays([pa.array(part), vecs], schema=schema)
    return fn


def _id(name: str):
    """The id as an INT; what is null or no whole number of that range is an error."""
    c = F.col(name)
    text = F.concat(F.lit(f"{name}: ids must be whole numbers in integer range, found "), F.coalesce(c.cast("string"), F.lit("null")))
    return F.when(c.isNotNull() & (c.cast("double") == c.try_cast("int").cast("double")), c.try_cast("int")).otherwise(F.raise_error(text).cast("int"))


def _rating(name: str):
    c = F.col(name).cast("float")
    text = F.lit(f"{name}: ratings must not be null, NaN or infinite")
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), c).otherwise(F.raise_error(text).cast("float"))


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _blocks(ratings: int, others: int, rank: int, cores: int, asked: int | None) -> int:
    """Blocks of one side: no more than memory asks for, as each reads all factors of the ``others``, but one a core."""
    share = BLOCK_NUMBERS / (rank * max(1, others))             # of the others' vectors that a block may name
    named = others * -math.log1p(-share) if share < 1 else math.inf     # ratings that name so many, at random
    n = max(1, math.ceil(ratings / min(named, BLOCK_RATINGS)))
    if n > cores:
        n = cores * -(-n // cores)
    return max(n, asked or min(cores, -(-ratings // LEAST_RATINGS)))


def fit_implicit(ratings: DataFrame, user_col: str, item_col: str, rating_col: str, rank: int, iterations: int, reg: float,
                 alpha: float, seed: int, user_blocks: int | None = None, item_blocks: int | None = None) -> dict[str, DataFrame]:
    """(id INT, features ARRAY<FLOAT>) of ``user`` and ``item``."""
    spark = ratings.sparkSession
    rows, rows_path = _write(ratings.select(_id(user_col).alias("user"), _id(item_col).alias("item"), _rating(rating_col).alias("rating")), "als-ratings")
    n, *ids = rows.agg(F.count(F.lit(1)), F.approx_count_distinct("user"), F.approx_count_distinct("item")).first()
    if not n:
        raise ValueError("no ratings to fit to")
    cores = spark.sparkContext.defaultParallelism
    blocks = {"user": _blocks(n, ids[1], rank, cores, user_blocks), "item": _blocks(n, ids[0], rank, cores, item_blocks)}
    place = {s: F.pmod(F.hash(s), F.lit(blocks[s])) for s in blocks}
    packed = {}
    for own, other in (("user", "item"), ("item", "user")):
        cells = rows.select(place[own].alias("block"), F.col(own).alias("id"), place[other].alias("far"), F.col(other).alias("other"), "rating")
        # twice as many ranges as blocks: no range holds two
        dealt = cells.repartitionByRange(2 * blocks[own], "block")
        packed[own] = dealt.mapInArrow(_pack_fn(blocks[other]), _RATINGS).persist(StorageLevel.DISK_ONLY)
        packed[own].count()
    # the solved records' own blocks come from the crossing, so both sides' records keep their numbers
    first = packed["user"].select("block", "ids").mapInArrow(_first_fn(rank, seed), _FACTORS)
    held = {"user": _write(first, "als-factors")}

    def half(own: str, other: str) -> None:
        factors = held[other][0]
        sums = factors.where(F.col("gram").isNotNull()).select("block", "gram").collect()       # rank x rank numbers a block
        sent = min(r["block"] for r in sums)
        axis, turn = np.linalg.eigh(sum(np.frombuffer(r["gram"]).reshape(rank, rank) for r in sums))
        left = factors.select(F.col("block").alias("f_block"), F.col("ids").alias("f_ids"), F.col("vecs").alias("f_vecs")).coalesce(1)
        start, end = F.col("starts")[F.col("f_block")], F.col("starts")[F.col("f_block") + 1]
        # ratings go along once a block, with every record only where normal equations add up on the way
        along = F.col("hot") | (F.col("f_block") == F.lit(sent))
        pairs = left.crossJoin(packed[own].hint("shuffle_replicate_nl")).select(
            "f_ids", "f_vecs", "block", "hot", "named", start.alias("first"),
            F.col("need").substr((start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")).alias("need"),
            *[F.when(along, F.col(c)).alias(c) for c in ("ids", "bounds", "at", "vals")])
        solved = pairs.mapInArrow(_solve_fn(rank, reg, alpha, turn, np.maximum(axis, 0.0)), _FACTORS)
        before, usual = held.get(own), spark.conf.get(_BYTES)
        spark.conf.set(_BYTES, BATCH_BYTES)
        try:
            held[own] = _write(solved, "als-factors")
        finally:
            spark.conf.set(_BYTES, usual)
        if before:
            removed(spark, before[1])

    try:
        for _ in range(iterations):
            for own, other in (("item", "user"), ("user", "item")):
                half(own, other)
        out = {s: held[s][0].select("ids", "vecs").mapInArrow(_rows_fn(rank), _ROWS) for s in held}
        out = {s: _write(df, f"als-{s}-factors")[0] for s, df in out.items()}
        for _, path in held.values():
            removed(spark, path)
    finally:
        for df in packed.values():
            df.unpersist()
        removed(spark, rows_path)
        free_shuffles(spark)
    # rows of a side that was asked for in so many blocks stay in as many
    for s, asked in (("user", user_blocks), ("item", item_blocks)):
        if asked:
            out[s] = out[s].repartition(blocks[s], "id")
    return out
