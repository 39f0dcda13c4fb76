"""Offline evaluation of recommendation lists.

Everything is exploded to long form and evaluated with equi-joins:

* list evaluation: ``recs (key, pos, other)`` meets ``truth (key, item)`` on the
  composite key (key, item) - no per-key loops, no set objects;
* basket evaluation: ``(key, basket)`` memberships meet the key's list on
  ``key`` (at most N rows per membership) and then the basket contents on
  ``(basket, item)``.  The work is linear in memberships x N; no pair of
  basket items is ever formed, so a huge basket or a hot key stays cheap
  (AQE splits a skewed key; the list side has at most N rows per key).

Definitions (N = list length considered, idx = zero-based first position):
  list:   g = sum_{x in T and top-N}(1 - idx/N) / |T|;  score = g / ((N+1)/2) / |T|
  basket: per basket B holding the key, g_B = sum(1 - idx/N) / (|B| - 1)
          (0 if |B| = 1 or no hit); score = (sum_B g_B / ((N+1)/(2N))) / #B
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lists import parse_basket_line, parse_rec_line, parse_validation_line
from ..session import written


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach a global aggregate (an ``agg`` without grouping: exactly one row).

    The only cross joins of this module are of this kind: the right side is
    one broadcast row, so the output has as many rows as ``df``.
    """
    return df.crossJoin(F.broadcast(totals))


# ------------------------------------------------------------------ parsing
@dataclass
class ParsedRecs:
    lines: DataFrame   # every line: key, has_comma, recs, line_order
    lists: DataFrame   # one row per key (the last line wins): key, has_comma, recs

    def long(self) -> DataFrame:
        """(key, pos, other) of the kept lists."""
        return self.lists.select("key", F.posexplode("recs").alias("pos", "other"))


def parse_recommendations(lines: DataFrame) -> ParsedRecs:
    """Lines (value, line_order) -> parsed lists; duplicate keys keep the last line."""
    key, has_comma, recs = parse_rec_line(F.col("value"))
    parsed = lines.select(key.alias("key"), has_comma.alias("has_comma"), recs.alias("recs"), "line_order")
    last = (parsed.groupBy("key")
            .agg(F.max_by(F.struct("has_comma", "recs"), F.col("line_order")).alias("l"))
            .select("key", "l.has_comma", "l.recs"))
    return ParsedRecs(parsed, last)


def duplicate_keys(parsed: ParsedRecs) -> DataFrame:
    """Keys that occur on more than one line, with the size of the kept list."""
    counts = parsed.lines.groupBy("key").agg(F.count(F.lit(1)).alias("n_lines"))
    return (counts.where(F.col("n_lines") > 1)
            .join(parsed.lists, "key")
            .select("key", "n_lines", F.size("recs").alias("kept_recs")))


def lists_from_long(recs: DataFrame, key: str = "key", pos: str = "pos", other: str = "other") -> ParsedRecs:
    """Build the parsed form from a long (key, pos, other) table (every key has a list)."""
    arr = (recs.groupBy(key)
           .agg(F.sort_array(F.collect_list(F.struct(pos, other))).alias("_s"))
           .select(F.col(key).alias("key"), F.lit(True).alias("has_comma"),
                   F.col("_s." + other).alias("recs")))
    return ParsedRecs(arr.withColumn("line_order", F.lit(None).cast("long")), arr)


def parse_validation(lines: DataFrame) -> DataFrame:
    """(key, item) rows of ``key,a; b; c`` lines (value, line_order), entries trimmed and de-duplicated.

    The last line of a key wins; lines without a comma are ``validation_rejects``.
    """
    key, ok, items = parse_validation_line(F.col("value"))
    last = (lines.where(ok).select(key.alias("key"), items.alias("items"), "line_order")
            .groupBy("key").agg(F.max_by("items", "line_order").alias("items")))
    return last.select("key", F.explode("items").alias("item"))


def validation_rejects(lines: DataFrame) -> DataFrame:
    """Lines of a validation file that hold no comma."""
    return lines.where(~parse_validation_line(F.col("value"))[1]).select("value")


def parse_baskets(lines: DataFrame) -> DataFrame:
    """(basket, item) rows; the basket id is unique per line (not dense)."""
    return (lines.select(F.monotonically_increasing_id().alias("basket"),
                         parse_basket_line(F.col("value")).alias("items"))
            .select("basket", F.explode("items").alias("item")))


# ------------------------------------------------------------------ list evaluation
def first_hits(recs_long: DataFrame, truth: DataFrame, n: int) -> DataFrame:
    """(key, other, idx, gain) for list items in the truth set, top-N only, first position."""
    top = (recs_long.where(F.col("pos") < n)
           .groupBy("key", "other").agg(F.min("pos").alias("idx")))
    t = truth.select("key", F.col("item").alias("other")).distinct()
    return (top.join(t, ["key", "other"], "inner")
            .withColumn("gain", 1.0 - F.col("idx") / F.lit(float(n))))


def evaluate_lists(recs_long: DataFrame, keys: DataFrame, truth: DataFrame, n: int) -> DataFrame:
    """Per key present in both the results and the truth: hits, gain and score."""
    t_size = truth.groupBy("key").agg(F.countDistinct("item").alias("n_truth"))
    hits = first_hits(recs_long, truth, n).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_hits"), F.sum("gain").alias("gain_sum"))
    scored = (keys.select("key").distinct().join(t_size, "key", "inner")
              .join(hits, "key", "left")
              .fillna({"n_hits": 0, "gain_sum": 0.0}))
    coef = (n + 1) / 2.0
    score = F.col("gain_sum") / F.col("n_truth") / F.lit(coef) / F.col("n_truth")
    return scored.select("key", "n_truth", "n_hits", "gain_sum", score.alias("score"))


def rec_totals(parsed: ParsedRecs) -> DataFrame:
    """One row: total_recs (lines with a comma + all recs), number_lines, unique_apps."""
    tot = parsed.lines.agg(
        (F.sum(F.col("has_comma").cast("long")) + F.sum(F.size("recs"))).cast("long").alias("total_recs"))
    lines = parsed.lists.agg(F.count(F.lit(1)).alias("number_lines"))
    uniq = parsed.lines.select(F.explode("recs").alias("o")).agg(F.countDistinct("o").alias("unique_apps"))
    return with_totals(with_totals(tot, lines), uniq)


def rec_frequency(parsed: ParsedRecs) -> DataFrame:
    """Occurrences per recommended item over all lines."""
    return (parsed.lines.select(F.explode("recs").alias("other"))
            .groupBy("other").agg(F.count(F.lit(1)).alias("count")))


def diversity_index(parsed: ParsedRecs) -> DataFrame:
    """A10: sum p*log1p(p), its maximum log1p(total) and their ratio (as written)."""
    freq = rec_frequency(parsed)
    tot = rec_totals(parsed).select("total_recs")
    p = F.col("count") / F.col("total_recs")
    s = with_totals(freq, tot).agg(F.sum(p * F.log1p(p)).alias("diversity"),
                                F.first("total_recs").alias("total_recs"))
    s = s.withColumn("diversity", F.coalesce("diversity", F.lit(0.0)))
    mx = F.log1p(F.col("total_recs").cast("double"))
    return s.select("diversity", mx.alias("diversity_max"),
                    F.try_divide(F.col("diversity"), mx).alias("equability"))


def shannon_entropy(parsed: ParsedRecs) -> DataFrame:
    """Standard Shannon entropy -sum p ln p of the recommended-item distribution."""
    freq = rec_frequency(parsed)
    w = freq.agg(F.sum("count").alias("t"))
    p = F.col("count") / F.col("t")
    return with_totals(freq, w).agg(F.coalesce(-F.sum(p * F.log(p)), F.lit(0.0)).alias("entropy"),
                                 F.count(F.lit(1)).alias("n_items"))


def list_hit_stats(recs_long: DataFrame, keys: DataFrame, truth: DataFrame, n: int) -> DataFrame:
    """Distinct hit apps, total hits, keys with at least one hit (scored keys only)."""
    scored_keys = keys.select("key").distinct().join(truth.select("key").distinct(), "key", "left_semi")
    h = first_hits(recs_long, truth, n).join(scored_keys, "key", "left_semi")
    return h.agg(F.countDistinct("other").alias("unique_hits"),
                 F.count(F.lit(1)).alias("total_hits"),
                 F.countDistinct("key").alias("keys_with_hit"))


def key_coverage(parsed: ParsedRecs, truth: DataFrame) -> DataFrame:
    """Keys scored, keys missing from the truth, keys without a list."""
    tk = truth.select("key").distinct().withColumn("_in", F.lit(True))
    k = parsed.lists.join(tk, "key", "left")
    return k.agg(F.count_if(F.col("_in").isNotNull()).alias("keys_scored"),
                 F.count_if(F.col("_in").isNull()).alias("keys_not_in_truth"),
                 F.count_if(~F.col("has_comma")).alias("keys_without_list"))


def coverage_stats(parsed: ParsedRecs, truth: DataFrame) -> DataFrame:
    """Unique, total and integer percentage for results and truth."""
    t = rec_totals(parsed).select(F.lit("results").alias("side"), F.col("unique_apps").alias("unique"),
                                  F.col("total_recs").alias("total"))
    vk = truth.select("key").distinct()
    vals = vk.select(F.col("key").alias("a")).unionByName(truth.select(F.col("item").alias("a")))
    v = vals.agg(F.countDistinct("a").alias("unique"), F.count(F.lit(1)).alias("total")) \
        .select(F.lit("truth").alias("side"), "unique", "total")
    out = t.unionByName(v)
    return out.withColumn("percent", F.floor(F.try_divide(F.col("unique") * 100.0, F.col("total"))).cast("long"))


def content_summary(parsed: ParsedRecs, truth: DataFrame, n: int, name: str = "run") -> DataFrame:
    """The 16-column evaluation row of one result set."""
    long = parsed.long()
    per_key = evaluate_lists(long, parsed.lists, truth, n)
    agg = per_key.agg(F.sum("score").alias("sum_dcg"), F.count(F.lit(1)).alias("apps_scored"),
                      F.sum("n_hits").cast("long").alias("total_occurrences"))
    hits = list_hit_stats(long, parsed.lists, truth, n).select("unique_hits")
    tot = rec_totals(parsed)
    div = diversity_index(parsed)
    row = with_totals(with_totals(with_totals(agg, hits), tot), div)
    return _summary_columns(row, F.lit(name), n)


def _summary_columns(row: DataFrame, name, n: int) -> DataFrame:
    dcg = F.try_divide(F.col("sum_dcg"), F.col("apps_scored"))
    variation = F.try_divide(F.col("unique_apps").cast("double"), F.col("total_recs"))
    occ_norm = F.try_divide(F.col("total_occurrences").cast("double"), F.col("apps_scored"))
    recs_norm = F.try_divide(F.col("total_recs").cast("double"), F.col("number_lines") * float(n))
    return row.select(
        name.alias("name"), "total_recs", "number_lines", "unique_apps",
        F.coalesce("total_occurrences", F.lit(0)).cast("long").alias("total_occurrences"),
        F.col("unique_hits").alias("unique_occurrences"),
        F.try_divide(F.col("unique_hits").cast("double"), F.col("total_occurrences")).alias("unique_ratio"),
        "apps_scored", dcg.alias("dcg"), (F.lit(10000.0) * dcg + variation).alias("dcg_variation"),
        occ_norm.alias("occurrences_norm"), recs_norm.alias("total_recs_norm"),
        (occ_norm * recs_norm).alias("product"), "diversity", "diversity_max", "equability")


# ------------------------------------------------------------------ basket evaluation
def evaluate_baskets(recs_long: DataFrame, baskets: DataFrame, n: int,
                     keys: DataFrame | None = None, min_basket: int | None = None) -> DataFrame:
    """Per key (present in the results, in ``keys`` if given, and in >= 1 basket): score."""
    b = baskets.select("basket", "item").distinct()
    size = b.groupBy("basket").agg(F.count(F.lit(1)).alias("b_size"))
    if min_basket:
        size = size.where(F.col("b_size") >= min_basket)
    result_keys = recs_long.select("key").distinct()
    if keys is not None:
        result_keys = result_keys.join(keys.select("key").distinct(), "key", "left_semi")
    member = (b.join(size, "basket")
              .select("basket", "b_size", F.col("item").alias("key"))
              .join(result_keys, "key", "left_semi"))
    top = (recs_long.where(F.col("pos") < n).join(result_keys, "key", "left_semi")
           .groupBy("key", "other").agg(F.min("pos").alias("idx")))
    cand = member.join(top, "key", "inner")                          # <= N rows per membership
    hit = cand.join(b.select("basket", F.col("item").alias("other")), ["basket", "other"], "left_semi")
    per_b = hit.groupBy("key", "basket").agg(F.sum(1.0 - F.col("idx") / F.lit(float(n))).alias("gain"))
    g = (member.join(per_b, ["key", "basket"], "left")
         .withColumn("g", F.when(F.col("b_size") > 1,
                                 F.coalesce("gain", F.lit(0.0)) / (F.col("b_size") - 1)).otherwise(F.lit(0.0))))
    coef = ((n + 1) / 2.0) / n
    return (g.groupBy("key").agg(F.sum("g").alias("g_sum"), F.count(F.lit(1)).alias("n_baskets"))
            .select("key", "n_baskets", "g_sum", (F.col("g_sum") / F.lit(coef) / F.col("n_baskets")).alias("score")))


def basket_summary(recs_long: DataFrame, baskets: DataFrame, n: int, keys: DataFrame | None = None) -> DataFrame:
    """One row: baskets, result keys, test keys, sum/count/average of the key scores."""
    per_key = evaluate_baskets(recs_long, baskets, n, keys)
    s = per_key.agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("sum_dcg"), F.count(F.lit(1)).alias("n_keys"))
    users = baskets.agg(F.countDistinct("basket").alias("users"))
    rk = recs_long.select("key").distinct()
    if keys is not None:
        rk = rk.join(keys.select("key").distinct(), "key", "left_semi")
        nk = keys.agg(F.countDistinct("key").alias("keys"))
    else:
        nk = rk.agg(F.count(F.lit(1)).alias("keys"))
    recs = rk.agg(F.count(F.lit(1)).alias("recs"))
    return (with_totals(with_totals(with_totals(users, recs), nk), s)
            .withColumn("avg_dcg", F.try_divide(F.col("sum_dcg"), F.col("n_keys"))))


def basket_grid(recs_long: DataFrame, baskets: DataFrame, ns, keysets: DataFrame) -> DataFrame:
    """Basket evaluation of every (result set, validation set, key set, list length n) in one plan.

    ``keysets`` is (keyset, key).  ``recs_long`` may hold several result sets,
    named by a column ``run``, and ``baskets`` several validation sets, named by
    ``vset``; these columns are then part of the output.  A key's score depends
    on neither the key set nor the other runs, so each membership meets the
    key's list once, at the largest n; the gains of all n are sums over the same
    hits, and key sets are joined to the finished scores of the keys.
    Output per run: (run, vset,) n, keyset, users, recs, keys, sum_dcg, n_keys, avg_dcg.
    Runs without any scored key have zeros, and a null average.
    """
    ns = sorted(set(int(n) for n in ns))
    named = [c for c, df in (("run", recs_long), ("vset", baskets)) if c in df.columns]
    recs = recs_long if "run" in named else recs_long.withColumn("run", F.lit(""))
    sets = baskets if "vset" in named else baskets.withColumn("vset", F.lit(""))
    # written once: lists, memberships and keys are each read by several branches of the plan
    ks = written(keysets.select("keyset", "key").distinct(), "grid-keys")
    every = written(recs.select("run", "key", "other", "pos"), "grid-lists")
    lists = every.join(ks.select("key").distinct(), "key", "left_semi")
    rk = lists.select("run", "key").distinct()
    b = written(sets.select("vset", "basket", "item").distinct(), "grid-baskets")
    size = b.groupBy("vset", "basket").agg(F.count(F.lit(1)).alias("b_size"))
    # gains of a key: one row a hit, whatever the number of runs of the grid
    top = lists.where(F.col("pos") < ns[-1]).groupBy("run", "key", "other").agg(F.min("pos").alias("idx"))
    member = b.join(size.where("b_size > 1"), ["vset", "basket"]).withColumnRenamed("item", "key")
    cand = member.join(top, "key")                                               # <= N rows per membership and result set
    hit = cand.join(b.withColumnRenamed("item", "other"), ["vset", "basket", "other"], "left_semi")
    gains = hit.groupBy("run", "vset", "key").agg(*[
        F.sum(F.when(F.col("idx") < n, (1.0 - F.col("idx") / F.lit(float(n))) / (F.col("b_size") - 1))).alias(f"g{n}") for n in ns])
    held = b.groupBy("vset", F.col("item").alias("key")).agg(F.count(F.lit(1)).alias("nb")).join(rk, "key")
    score = [(F.coalesce(f"g{n}", F.lit(0.0)) / F.lit(((n + 1) / 2.0) / n) / F.col("nb")).alias(f"s{n}") for n in ns]
    per_key = held.join(gains, ["run", "vset", "key"], "left").select("run", "vset", "key", *score)
    per_run = per_key.join(ks, "key").groupBy("run", "vset", "keyset").agg(
        F.count(F.lit(1)).alias("n_keys"), *[F.sum(f"s{n}").alias(f"s{n}") for n in ns])
    # the runs: names of the sets only, a handful of rows
    users = size.groupBy("vset").agg(F.count(F.lit(1)).alias("users"))
    vsets = users.agg(F.collect_list(F.struct("vset", "users")).alias("v"))
    runs = every.select("run").distinct().agg(F.collect_list("run").alias("r"))
    grid = with_totals(with_totals(ks.groupBy("keyset").agg(F.count(F.lit(1)).alias("keys")), vsets), runs)
    grid = grid.select("keyset", "keys", "v", F.explode_outer("r").alias("run")).select(
        "keyset", "keys", "run", F.inline_outer("v"))
    listed = rk.join(ks, "key").groupBy("run", "keyset").agg(F.count(F.lit(1)).alias("recs"))
    out = grid.join(per_run, ["run", "vset", "keyset"], "left").join(listed, ["run", "keyset"], "left")
    out = out.withColumn("x", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"s{n}").alias("s")) for n in ns])))
    return out.select(*named, "x.n", "keyset", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("users", "recs")],
                      "keys", F.coalesce("x.s", F.lit(0.0)).alias("sum_dcg"),
                      F.coalesce("n_keys", F.lit(0)).cast("long").alias("n_keys"),
                      F.try_divide(F.coalesce("x.s", F.lit(0.0)), F.coalesce("n_keys", F.lit(0))).alias("avg_dcg"))


def evaluate_runs(lines: DataFrame, truth: DataFrame, n: int) -> DataFrame:
    """The 16-column summary of every result set in ``lines`` (value, line_order, run).

    One plan for all runs: ``run`` is a grouping key of every aggregate, and
    the per-run totals (one row a run) are joined on it.
    """
    key, has_comma, recs = parse_rec_line(F.col("value"))
    # written once: lines and hits are each read by several branches of the plan
    parsed = written(lines.select("run", key.alias("key"), has_comma.alias("has_comma"), recs.alias("recs"), "line_order"), "run-lines")
    lists = (parsed.groupBy("run", "key").agg(F.max_by("recs", "line_order").alias("recs")))
    items = parsed.select("run", F.explode("recs").alias("other")).groupBy("run", "other").agg(
        F.count(F.lit(1)).alias("count"))
    totals = parsed.groupBy("run").agg(
        (F.sum(F.col("has_comma").cast("long")) + F.sum(F.size("recs"))).cast("long").alias("total_recs"))
    number = lists.groupBy("run").agg(F.count(F.lit(1)).alias("number_lines"))
    p = F.col("count") / F.col("total_recs")
    spread = items.join(totals, "run").groupBy("run").agg(
        F.count(F.lit(1)).alias("unique_apps"), F.sum(p * F.log1p(p)).alias("diversity"))

    t = written(truth.select("key", F.col("item").alias("other")).distinct(), "run-truth")
    scored = lists.select("run", "key").join(t.groupBy("key").agg(F.count(F.lit(1)).alias("n_truth")), "key")
    top = (lists.select("run", "key", F.posexplode("recs").alias("pos", "other")).where(F.col("pos") < n)
           .groupBy("run", "key", "other").agg(F.min("pos").alias("idx")))
    hits = written(top.join(t, ["key", "other"]), "run-hits")
    gains = hits.groupBy("run", "key").agg(F.count(F.lit(1)).alias("n_hits"),
                                           F.sum(1.0 - F.col("idx") / F.lit(float(n))).alias("gain"))
    score = F.coalesce("gain", F.lit(0.0)) / F.col("n_truth") / F.lit((n + 1) / 2.0) / F.col("n_truth")
    dcg = scored.join(gains, ["run", "key"], "left").groupBy("run").agg(
        F.sum(score).alias("sum_dcg"), F.count(F.lit(1)).alias("apps_scored"),
        F.coalesce(F.sum("n_hits"), F.lit(0)).cast("long").alias("total_occurrences"))
    unique = hits.groupBy("run").agg(F.countDistinct("other").alias("unique_hits"))

    row = totals.join(number, "run").join(spread, "run", "left").join(dcg, "run", "left").join(unique, "run", "left")
    row = row.fillna(0, ["unique_apps", "diversity", "apps_scored", "total_occurrences", "unique_hits"])
    return _summary_columns(row.withColumn("diversity_max", F.log1p(F.col("total_recs").cast("double")))
                            .withColumn("equability", F.try_divide("diversity", "diversity_max")), F.col("run"), n)


def summary_line(summary: DataFrame) -> DataFrame:
    """K6: one text line a run, ``name: dcg=..., hits=..., coverage=...``."""
    return summary.select("name", F.format_string(
        "%s: dcg=%.6f hits=%d unique_hits=%d unique_apps=%d total_recs=%d", "name", F.coalesce("dcg", F.lit(0.0)),
        "total_occurrences", "unique_occurrences", "unique_apps", "total_recs").alias("line"))
