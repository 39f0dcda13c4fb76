"""Host-level quality rules (operator 4), DataFrame functions only.

Every document gets text statistics and rule failures.  Failures are summed
per host; an empirical beta prior, fitted to all hosts by moments, shrinks each
host's failure rate, so a host with a few documents is pulled towards the
corpus rate.  Hosts whose shrunken rate is above ``host_limit`` are *strict*:
their documents are held to tighter limits.  The verdict of the host is joined
back to its documents; a document that breaks no rule stays, whatever its host.

Defined cases: null or empty text has no words and fails the base rule; a null
host is a host of its own; repeated rows are judged alike; an empty table gives
an empty result; columns of the input never clash with the statistics, which
are kept apart in a struct of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table, words_of

MIN_WORDS = 50
HAS_WORD = r"[^\x20\x09-\x0D]"

#: Limits of the document rules, as shares; strict hosts get ``STRICT`` times these.
MAX_SYMBOLS_PER_WORD = 0.10
MAX_DUP_LINES = 0.30
STRICT = 0.5
HOST_LIMIT = 0.5


def _neighbours(a: Column, fn) -> Column:
    """``fn(a[i], a[i+1])`` for all i, without capturing the array in a lambda."""
    n = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(2), n), fn)


def text_statistics(df: DataFrame, text: Column) -> DataFrame:
    """Add ``_f`` (a struct of statistics) to ``df``; each step reads columns of the step before."""
    keep = df.columns
    step = df.withColumn("_t", F.coalesce(text, F.lit("")))
    step = step.withColumn("_w", words_of(F.col("_t")))
    step = step.withColumn("_l", F.filter(F.split("_t", "\n"), lambda l: l.rlike(HAS_WORD)))
    # 64-bit codes of the words and of all windows of three
    step = step.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    m = F.greatest(F.size("_h") - 2, F.lit(0))
    step = step.withColumn("_z", F.arrays_zip(F.slice("_h", F.lit(1), m).alias("a"), F.slice("_h", F.lit(2), m).alias("b"),
                                              F.slice("_h", F.lit(3), m).alias("c")))
    step = step.withColumn("_g", F.transform("_z", lambda z: F.xxhash64(z["a"], z["b"], z["c"])))
    # only texts with a repeated window sort their windows: (code, place), equal codes side by side
    step = step.withColumn("_s", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    step = step.withColumn("_p", F.when(F.col("_s").isNotNull(), F.array_sort(F.array_distinct(F.flatten(
        _neighbours(F.col("_s"), lambda x, y: F.when(x["g"] == y["g"], F.array(x["i"], y["i"]))
                    .otherwise(F.array().cast("array<int>"))))))))
    repeat = F.when(F.col("_p").isNotNull(), F.lit(3) + F.aggregate(
        _neighbours(F.col("_p"), lambda x, y: F.least(y - x, F.lit(3))), F.lit(0), lambda s, x: s + x)).otherwise(0)
    return step.select(*keep, F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words")).alias("_f"))


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


def rule_failed(f: Column, factor: Column) -> Column:
    """Breaks one of the document rules, whose limits are multiplied by ``factor``."""
    return ((f["n_symbols"] > factor * MAX_SYMBOLS_PER_WORD * f["n_words"])
            | (f["n_dup_lines"] > factor * MAX_DUP_LINES * f["n_lines"]))


def host_verdicts(stats: DataFrame, host: str = "_host", host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row a host: documents, failures, shrunken failure rate and whether it is strict.

    The prior is Beta(a, b) with the corpus mean and the between-host
    correlation rho of the moment (analysis-of-variance) estimator;
    a + b = 1 / rho - 1.
    """
    f = F.col("_f")
    failed = (base_failed(f) | rule_failed(f, F.lit(1.0))).cast("long")
    hosts = stats.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(failed).alias("n_failed"))
    total = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                      F.sum(F.col("n_docs") * F.col("n_docs").cast("double")).alias("nn"),
                      F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff")).first()
    mean, size = _beta_prior(total)
    rate = (F.col("n_failed") + mean * size) / (F.col("n_docs") + size)
    return hosts.select(host, "n_docs", "n_failed", rate.alias("rate"), (rate > host_limit).alias("strict"))


def _beta_prior(t) -> tuple[float, float]:
    """Mean and weight a + b of the prior from the totals over all hosts (one row of numbers)."""
    k, n, f = t["k"] or 0, float(t["n"] or 0), float(t["f"] or 0)
    mean = (f + 1.0) / (n + 2.0)
    spread = mean * (1.0 - mean)
    between = float(t["ff"] or 0.0) - (f * f / n if n else 0.0)          # sum n_h (p_h - p)^2
    free = n - (float(t["nn"] or 0.0) / n if n else 0.0) - (k - 1)
    rho = (between - spread * (k - 1)) / (spread * free) if free > 0 else 0.5
    rho = min(max(rho, 1e-3), 0.9)
    return mean, 1.0 / rho - 1.0


def judged(docs: DataFrame, text_col: str = "text", host_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` as struct ``_d``, its statistics ``_f``, the host's rate, base_failed and kept.

    ``carry``: the columns that ``_d`` has; all by default.
    """
    cols = [F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)]
    rows = docs.select(F.struct(*cols).alias("_d"), F.col(host_col).cast("string").alias("_host"),
                       F.col(text_col).alias("_text"))
    stats = saved(text_statistics(rows, F.col("_text")).drop("_text"), "quality")
    hosts = host_verdicts(stats).withColumnRenamed("_host", "_h2")
    f = F.col("_f")
    factor = F.when(F.col("strict"), F.lit(STRICT)).otherwise(F.lit(1.0))
    return (stats.join(hosts, F.col("_host").eqNullSafe(F.col("_h2")), "left")
            .select("_d", "_f", "_host", F.col("rate").alias("host_rate"), base_failed(f).alias("base_failed"),
                    (~base_failed(f) & ~rule_failed(f, factor)).alias("kept")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep to the rules, with their own columns."""
    return judged(docs).where("kept").select("_d.*")


def op4_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    out = judged(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("_d.doc_id", *[f"_f.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                         "n_repeat_words")], "base_failed", "kept")


QUERIES = {"op4_host_quality": op4_host_quality}
SQL = {"op4_host_quality": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id
), f AS (
  SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
         length(list_aggregate(list_concat(words, ['']), 'string_agg', ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
), h AS (
  SELECT source, count(*)::DOUBLE AS n,
         sum((base_failed OR n_symbols > 0.10 * n_words OR n_dup_lines > 0.30 * n_lines)::INT)::DOUBLE AS x
  FROM b GROUP BY source
), t AS (
  SELECT (sum(x) + 1) / (sum(n) + 2) AS mean, sum(x * x / n) - sum(x) * sum(x) / sum(n) AS between_,
         sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS free, count(*) - 1 AS k1 FROM h
), p AS (
  SELECT mean, 1.0 / least(greatest(CASE WHEN free > 0 THEN
           (between_ - mean * (1 - mean) * k1) / (mean * (1 - mean) * free) ELSE 0.5 END, 1e-3), 0.9) - 1 AS size FROM t
), v AS (
  SELECT source, CASE WHEN (x + mean * size) / (n + size) > 0.5 THEN 0.5 ELSE 1.0 END AS factor FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_symbols > factor * 0.10 * n_words OR n_dup_lines > factor * 0.30 * n_lines) AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""}
