"""Implicit-feedback matrix preparation.

Install log -> distinct (user, item) pairs -> well-formed items -> blacklist ->
minimum-downloads filter -> dense ids -> (user INT, item INT, rating DOUBLE),
plus the item histogram.  Every step is a DataFrame transformation; the only
shuffles are the distinct, the semi-join to the kept catalogue and the two id
joins (which AQE turns into broadcasts when the id maps are small).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..session import checkpoint_dir
from .ids import assign_ids

# Fixed value: an item name must contain a dot with something on both sides.
DOTTED_PATTERN = r".+\..+"


# --------------------------------------------------------------------- S1 / F11
def month_bounds(as_of, n_months: int) -> tuple[_dt.date, _dt.date]:
    """[first day of the month n months before as_of's month, first day of as_of's month)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of[:10])
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    end = as_of.replace(day=1)
    months = end.year * 12 + (end.month - 1) - n_months
    start = _dt.date(months // 12, months % 12 + 1, 1)
    return start, end


def month_window(df: DataFrame, as_of, n_months: int, year_col: str = "year",
                 month_col: str = "month") -> DataFrame:
    """Rows of the ``n_months`` calendar months before ``as_of`` (its month excluded).

    The predicate only references the partition columns, so on a
    ``year=/month=`` layout it becomes a partition filter (no file of another
    month is listed or opened).
    """
    start, end = month_bounds(as_of, n_months)
    ym = F.col(year_col) * 12 + F.col(month_col)
    lo = start.year * 12 + start.month
    hi = end.year * 12 + end.month
    return df.where((ym >= F.lit(lo)) & (ym < F.lit(hi)))


def read_install_log(spark, root: str, as_of, n_months: int, schema=None) -> DataFrame:
    """Install log stored as ``root/year=Y/month=M/...`` Parquet, pruned to the window."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return month_window(reader.parquet(root), as_of, n_months)


# --------------------------------------------------------------------- P1 / A1
def install_pairs(logs: DataFrame, user_col: str = "hash", item_col: str = "pkg",
                  out_user: str = "hash", out_item: str = "package") -> DataFrame:
    """Distinct (user, item) pairs; an array-valued item column is exploded."""
    item = F.col(item_col)
    if isinstance(logs.schema[item_col].dataType, ArrayType):
        item = F.explode(item)
    return logs.select(F.col(user_col).alias(out_user), item.alias(out_item)).distinct()


# --------------------------------------------------------------------- P2
def wellformed_items(df: DataFrame, item_col: str = "package") -> DataFrame:
    return df.where(F.col(item_col).rlike(DOTTED_PATTERN))


# --------------------------------------------------------------------- P3 / U4
def _quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def blacklist_regex(names: Iterable[str] = (), patterns: Iterable[str] = (),
                    mode: str = "exact") -> str | None:
    """Regex equal to the blacklist: names (regex mode only) and ``.+\\.<pattern>``."""
    names = sorted(set(names)) if mode == "regex" else []
    patterns = sorted(set(patterns))
    alts = [f"({n})" for n in names]
    if patterns:
        if mode == "regex":
            alts += [f"(.+\\.{p}.*)" for p in patterns]
        else:
            alts.append(".+\\.(?:" + "|".join(_quote(p) for p in patterns) + ")")
    return "|".join(alts) if alts else None


def filter_blacklist(df: DataFrame, item_col: str = "package", names=None,
                     patterns: Iterable[str] = (), mode: str = "exact") -> DataFrame:
    """Remove blacklisted items.

    ``mode='exact'``: ``names`` (a list or a one-column DataFrame) must equal the
    item; ``patterns`` are literal words matched as ``.+\\.<word>`` anywhere.
    ``mode='regex'``: the literal behaviour - names and patterns are unescaped
    alternatives of one unanchored regex.  An empty blacklist filters nothing.
    """
    if mode not in ("exact", "regex"):
        raise ValueError("mode must be 'exact' or 'regex'")
    out = df
    if mode == "exact" and names is not None:
        if isinstance(names, DataFrame):
            name_df = names.select(F.col(names.columns[0]).alias("_bl")).distinct()
        else:
            values = sorted(set(names))
            name_df = df.sparkSession.createDataFrame([(v,) for v in values], "_bl string")
            name_df = F.broadcast(name_df)  # parameter list: size known on the driver
        out = out.join(name_df, out[item_col] == name_df["_bl"], "left_anti")
    if mode == "regex" and isinstance(names, DataFrame):
        raise ValueError("regex mode takes the names as a list")
    rx = blacklist_regex(names if mode == "regex" and names is not None else (), patterns, mode)
    if rx:
        out = out.where(~F.col(item_col).rlike(rx))
    return out


# --------------------------------------------------------------------- P4 / J1 / J2
def filter_min_downloads(df: DataFrame, id_map: DataFrame, downloads: DataFrame,
                         item_col: str = "package", min_exclusive: int = 500,
                         map_id: str = "id", map_name: str = "data",
                         dl_key: str = "app_package", dl_count: str = "downloads") -> DataFrame:
    """Keep rows whose item has strictly more than ``min_exclusive`` downloads.

    The two lookup tables are joined to each other first (catalogue-sized), and
    the pairs meet the result once, as a semi-join: no lookup column is carried
    and no de-duplication pass is needed afterwards.
    """
    popular = downloads.where(F.col(dl_count) > F.lit(min_exclusive)).select(F.col(dl_key).alias("_k"))
    names = (id_map.select(F.col(map_id).alias("_k"), F.col(map_name).alias("_name"))
             .join(popular, "_k", "left_semi").select("_name"))
    return df.join(names, df[item_col] == names["_name"], "left_semi")


# --------------------------------------------------------------------- J3 / P5
def encode(pairs: DataFrame, users: DataFrame, items: DataFrame, user_col: str = "hash",
           item_col: str = "package", user_id: str = "user_id", item_id: str = "app_id",
           rating: float | Column = 1.0) -> DataFrame:
    """(user INT, item INT, rating DOUBLE) from string pairs and the two id maps."""
    r = rating if isinstance(rating, Column) else F.lit(float(rating))
    return (pairs.join(users, user_col, "inner").join(items, item_col, "inner")
            .select(F.col(user_id).alias("user"), F.col(item_id).alias("item"),
                    r.cast("double").alias("rating")))


def decode(df: DataFrame, ids: DataFrame, id_col: str, id_key: str, name_col: str,
           out_col: str) -> DataFrame:
    """Attach the name of an id column (left join, unknown ids keep NULL)."""
    dim = ids.select(F.col(id_key).alias(id_col), F.col(name_col).alias(out_col))
    return df.join(dim, id_col, "left")


def prepare_ratings(pairs: DataFrame, user_col: str = "hash", item_col: str = "package",
                    materialize: bool = True):
    """(pairs, users, items, ratings): dense ids for both sides and the encoded matrix.

    The filtered pairs feed both id maps and the encoding; with
    ``materialize`` they are computed once and checkpointed to the session's
    checkpoint folder (reliable storage), instead of re-running the scan,
    joins and filters for each consumer.
    """
    if materialize:
        checkpoint_dir(pairs.sparkSession)
        pairs = pairs.checkpoint(eager=True)
    users = assign_ids(pairs, user_col, "user_id")
    items = assign_ids(pairs, item_col, "app_id")
    return pairs, users, items, encode(pairs, users, items, user_col, item_col)


# --------------------------------------------------------------------- A2 / J4
def item_histogram(ratings: DataFrame, items: DataFrame, item_col: str = "item",
                   item_id: str = "app_id", item_name: str = "package") -> DataFrame:
    """Installs per item, share of all rows in percent, item name attached."""
    names = items.select(F.col(item_id).alias(item_col), F.col(item_name).alias("package"))
    return (_shares(ratings, item_col).join(names, item_col, "left")
            .select("package", "count", "percentage"))


def package_histogram(pairs: DataFrame, item_col: str = "package") -> DataFrame:
    """The same from the pairs themselves: no id is needed to count names."""
    return _shares(pairs, item_col).select(F.col(item_col).alias("package"), "count", "percentage")


def _shares(rows: DataFrame, item_col: str) -> DataFrame:
    """Rows per item and their share; the total is one row, summed from the same counts."""
    counts = rows.groupBy(item_col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").cast("double").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select(item_col, "count", (F.col("count") / F.col("_total") * 100.0).alias("percentage")))


# --------------------------------------------------------------------- S14
def source_mark(source: DataFrame) -> str:
    """Number of rows and sum of row hashes: the same for the same rows in any order."""
    row = source.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in source.columns]).cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


def _record(spark, path: str):
    """The commit record below ``path``, or None where none was finished."""
    try:
        rows = spark.read.schema("folder string, columns string, n_rows long, source string").json(f"{path}/_record").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows[0] if len(rows) == 1 and rows[0]["folder"] else None


def ratings_or_build(spark, path: str, build, source: DataFrame | None = None) -> DataFrame:
    """Reuse prepared ratings stored below ``path``, else build and store them.

    ``build`` is a zero-argument callable returning the ratings DataFrame.  Each
    build writes to a folder of its own; a record of the folder, its columns,
    its number of rows and the mark of ``source`` is written last.  Whatever has
    no such record, another number of rows, or another source than asked for is
    built anew, so neither an unfinished write nor old input is taken for a result.
    """
    path = path.rstrip("/")
    mark = source_mark(source) if source is not None else ""
    record = _record(spark, path)
    if record is not None and record["source"] == mark:
        stored = spark.read.schema(StructType.fromJson(json.loads(record["columns"]))).parquet(f"{path}/{record['folder']}")
        try:
            if stored.count() == record["n_rows"]:
                return stored
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    folder = f"data-{uuid.uuid4().hex[:12]}"
    rows = build()
    rows.write.parquet(f"{path}/{folder}")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
    spark.createDataFrame([(folder, rows.schema.json(), stored.count(), mark)],
                          "folder string, columns string, n_rows long, source string").coalesce(1).write.mode("overwrite").json(f"{path}/_record")
    return stored
