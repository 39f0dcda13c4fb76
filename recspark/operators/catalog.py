"""Catalog ingest and app-metadata records.

JSON is read with an explicit schema in PERMISSIVE mode with a corrupt-record
column; rows failing to parse or breaking a NOT NULL rule come back as a
second DataFrame of rejects instead of aborting the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import checkpoint_dir
from .ids import assign_ids

CORRUPT = "_corrupt_record"
#: The package name in a line that does not parse as JSON.
PACKAGE_FIELD = r'"package"\s*:\s*"([^"]*)"'

CATALOG_SCHEMA = StructType([
    StructField("package", StringType()), StructField("category", StringType()),
    StructField("downloads", LongType()), StructField("description", StringType()),
    StructField("developer", StringType())])
CATALOG_REQUIRED = ["package", "category", "downloads", "description", "developer"]


def _s(*names):
    return [StructField(n, StringType()) for n in names]


METADATA_SCHEMA = StructType([
    StructField("info", StructType(_s("status"))),
    StructField("data", StructType([
        StructField("id", LongType()), *_s("package", "name", "icon", "icon_hd"),
        StructField("store", StructType(_s("name"))),
        StructField("file", StructType([*_s("md5sum"), StructField("malware", StructType(_s("rank")))])),
        StructField("media", StructType(_s("description"))),
        StructField("urls", StructType(_s("w"))),
        StructField("stats", StructType([StructField("pdownloads", LongType())])),
    ])),
])


def read_json_checked(spark: SparkSession, path, schema: StructType):
    """(rows, corrupt): rows parsed with ``schema``; corrupt holds the raw text of bad lines.

    Lines are read as text and parsed with ``from_json`` (PERMISSIVE, corrupt
    column), so the raw line stays at hand for the rejects and no query ever
    reads the corrupt column alone from the file source.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    df = spark.read.text(path).select(F.col("value").alias("raw"),
                                      F.from_json("value", full, opts).alias("j"))
    bad_line = F.col("j").isNull() | F.col(f"j.{CORRUPT}").isNotNull()
    good = df.where(~bad_line).select("j.*").drop(CORRUPT)
    bad = df.where(bad_line).select("raw")
    return good, bad


def ingest_catalog(spark: SparkSession, path, required=CATALOG_REQUIRED):
    """(accepted, rejects): rejects are (package, reason) with reason 'parse' or 'null'."""
    rows, bad = read_json_checked(spark, path, CATALOG_SCHEMA)
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    accepted = rows.where(ok)
    nulls = rows.where(~ok).select("package", F.lit("null").alias("reason"))
    parse = bad.select(F.regexp_extract("raw", PACKAGE_FIELD, 1).alias("package"),
                       F.lit("parse").alias("reason"))
    return accepted, nulls.unionByName(parse)


def category_list(catalog: DataFrame, category_col: str = "category") -> DataFrame:
    return catalog.select(category_col).distinct()


def parse_metadata(spark: SparkSession, path, as_of: str):
    """(records, rejects, status_counts) of app-metadata JSON lines.

    records: the 13-column flat row of every record with status OK; ``id``
    numbers the records, in order of package, from 1 (records of one package
    get a number each, those without a package come last); a missing ``icon_hd`` becomes ''
    and a missing download count stays NULL.  rejects: (package, reason).
    """
    checkpoint_dir(spark)
    rows, bad = read_json_checked(spark, path, METADATA_SCHEMA)
    ok = rows.where(F.col("info.status") == "OK")
    flat = ok.select(
        F.col("data.id").alias("appID"), F.col("data.file.md5sum").alias("MD5"),
        F.col("data.file.malware.rank").alias("malware"), F.col("data.name").alias("title"),
        F.col("data.package").alias("packageName"), F.col("data.media.description").alias("description"),
        F.col("data.urls.w").alias("wUrl"), F.col("data.icon").alias("icon"),
        F.coalesce(F.col("data.icon_hd"), F.lit("")).alias("icon_hd"),
        F.col("data.stats.pdownloads").alias("downloadNo"), F.col("data.store.name").alias("store"),
        F.date_format(F.to_timestamp(F.lit(as_of)), "yyyy-MM-dd'T'HH:mm:ss").alias("crawlDate"))
    # the place in the file tells records of one package apart
    flat = flat.withColumn("_key", F.struct(F.col("packageName").isNull().alias("n"), F.col("packageName").alias("p"),
                                            F.monotonically_increasing_id().alias("r"))).checkpoint()
    ids = assign_ids(flat, "_key", "id", id_type="long")
    records = flat.join(ids, flat["_key"] == ids["_key"]).select(
        "id", "appID", "MD5", "malware", "title", "packageName", "description", "wUrl", "icon",
        "icon_hd", "downloadNo", "store", "crawlDate")
    status_rej = rows.where(F.coalesce(F.col("info.status"), F.lit("")) != "OK").select(
        F.col("data.package").alias("package"), F.coalesce(F.col("info.status"), F.lit("MISSING")).alias("reason"))
    parse_rej = bad.select(F.regexp_extract("raw", PACKAGE_FIELD, 1).alias("package"),
                           F.lit("PARSE_ERROR").alias("reason"))
    rejects = status_rej.unionByName(parse_rej)
    counts = (rows.select(F.coalesce(F.col("info.status"), F.lit("MISSING")).alias("status"))
              .unionByName(bad.select(F.lit("PARSE_ERROR").alias("status")))
              .groupBy("status").agg(F.count(F.lit(1)).alias("n")))
    return records, rejects, counts


def package_categories(packages: DataFrame, ids: DataFrame, names: DataFrame) -> DataFrame:
    """(package, category_id, category); packages without an id, and ids without a name, keep NULL.

    ``ids`` are (package, category_id), ``names`` (category_id, category).
    """
    return (packages.select("package").join(ids.select("package", "category_id"), "package", "left")
            .join(names.select("category_id", "category"), "category_id", "left")
            .select("package", "category_id", "category"))
