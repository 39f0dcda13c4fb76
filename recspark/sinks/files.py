"""Writers (K1, K2, K4, K5, K6): partitioned output, never a forced single file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False,
              single_file: bool = False, partition_by=None) -> str:
    """CSV output; ``single_file=True`` coalesces (small outputs only)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).options(**CSV_OPTIONS).option("header", str(header).lower())
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.csv(path)
    return path


def write_text(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite") -> str:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
    return path


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                fmt: str = "parquet") -> str:
    """Relational load target (``mode='overwrite'`` replaces DROP + CREATE)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return path


def sanitize_dir_name(col):
    """Category name usable as a directory: ``(``, ``)`` and ``,`` removed."""
    return F.regexp_replace(col, r"[(),]", "")


def export_by_category(df: DataFrame, path: str, category_col: str = "category",
                       columns=("package", "description"), files_per_category: int = 8) -> str:
    """One CSV folder per category in one pass (partitioned write, no driver loop).

    Rows are dealt by category and a salt, so a category has at most
    ``files_per_category`` files and a large one is not one task.
    """
    out = df.select(*columns, sanitize_dir_name(F.col(category_col)).alias("category_dir"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(files_per_category))
    return write_csv(out.repartition("category_dir", salt), path, partition_by="category_dir")
