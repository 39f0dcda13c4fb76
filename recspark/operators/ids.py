"""Dense surrogate ids without a single-partition window.

``assign_ids`` gives every distinct key the 1-based (or ``start``-based) rank
of the key in ascending order.  Plan: range-partition the distinct keys, sort
inside each partition, tag each row with its partition index and the
partition-local position (``monotonically_increasing_id`` keeps the position
in its low 33 bits), count rows per partition (one integer per partition - a
bound known before the job runs), turn the counts into running offsets and
broadcast them back.  Only the partition counts leave the executors; the
keys never leave their partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def assign_ids(df: DataFrame, key: str, id_col: str = "id", start: int = 1,
               num_partitions: int | None = None, id_type: str = "int") -> DataFrame:
    """Distinct non-null ``key`` values with a dense id in ascending key order.

    The positions are always checkpointed: a sampled range partitioning that
    is evaluated twice may cut its ranges differently, and would then give one
    id to two keys.
    """
    checkpoint_dir(df.sparkSession)
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (keys.repartitionByRange(n, key)
               .sortWithinPartitions(key)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    # the ids are a dimension that is joined twice (encode + decode);
    # cutting lineage keeps them identical even if an executor is lost
    ordered = ordered.checkpoint(eager=True)
    # one count per partition (a number of integers fixed by ``n``, not by the
    # data) -> running offsets on the driver -> broadcast back
    counts = sorted((r["_pid"], r["_n"]) for r in
                    ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    running, rows = 0, []
    for pid, cnt in counts:
        rows.append((pid, running))
        running += cnt
    offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "_pid int, _off long")
    out = ordered.join(F.broadcast(offsets), "_pid")
    return out.select(
        key, (F.col("_off") + F.col("_pos") + F.lit(start)).cast(id_type).alias(id_col))


def continue_ids(existing: DataFrame, new: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Ids for keys of ``new`` that are not in ``existing``, continuing after max(id).

    Equivalent of ``SELECT id ... ORDER BY id DESC LIMIT 1`` then ``id + 1`` per new key.
    """
    max_id = existing.agg(F.max(id_col)).first()[0] or 0   # one scalar
    fresh = new.select(key).join(existing.select(key), key, "left_anti")
    return assign_ids(fresh, key, id_col, start=int(max_id) + 1, id_type="long")


def work_slices(numbered: DataFrame, line_col: str, n_workers: int, total: int | None = None,
                slice_col: str = "slice") -> DataFrame:
    """Worker slice of every numbered line: ``step = int(total / n) + 1``.

    Line ``l`` (1-based) goes to slice ``(l - 1) // step``.
    """
    if total is None:
        total = numbered.count()
    step = int(total / n_workers) + 1
    return numbered.withColumn(slice_col, F.floor((F.col(line_col) - 1) / F.lit(step)).cast("int"))
