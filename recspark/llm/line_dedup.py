"""Line de-duplication by an exact set-similarity join (operator 8), DataFrame functions only.

A line's set is its distinct five-word shingles (lower case); with one to four
words, the whole sequence as one.  A line goes when an earlier line (smaller
document id, or further up) has a Jaccard similarity of 0.75 or more.

Shingles are ordered by rarity: those found in ``FREQUENT`` lines and more come
last, by their count, all others first, by hash (hardly any of them is found
twice).  Which are frequent is counted exactly, but only where it matters: on
the lines that have a frequent token among their first ones; the prefixes of
the other lines cannot change.  Two similar lines share a token in the first
``n - ceil(0.75 n) + 1`` of that order (prefix filter); pairs also pass a
length filter and positional bounds on their overlap, and are verified on full
sets.

No group becomes all its pairs: equal lines are resolved by one aggregate;
then each line is compared with the first line of each of its tokens, which
resolves the members of large groups; only lines that are still unmatched are
compared with everything earlier that shares a prefix token.  A line of one to
four words is similar to its copies alone, so the aggregate settles it.

Sets of lines go to all workers as one bit a line (up to 32 MB of bits; beyond,
they are shuffled); tokens that several lines have go there as bits of
shortened tokens, and few others pass these to the shuffled join.
Lines that go are bits as well: a document knows the number of its first line and
finds the bits of its lines beside it, so that no text is shuffled.
The shingles of a line are twice its text, so they are made again for the lines
that need them and not kept; what is kept of all lines are their prefixes.

Defined cases: null and empty texts have no lines; white-space-only lines stay;
null ids come last, rows with equal ids are ordered by their place in the
table; an empty table gives an empty result; columns of the input never clash,
as they travel in a struct.  Lines and shingles are named by 64-bit hashes.
``docs`` is read from files, so that its rows get the same numbers in every job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import free_shuffles
from .common import saved as written
from .common import small, table

SHINGLE = 5
#: Number of lines from which a token counts as frequent.
FREQUENT = 64
#: Most rows of the table of frequent tokens that is sent to all workers.
FEW = 400_000
#: Numbers that share one array of bits (4 KB).
RUN = 1 << 15
#: Most such arrays that are sent to all workers (32 MB).
RUNS = 8192


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back; the shuffle files of the step go before the next one."""
    out = written(df, name)
    free_shuffles(df.sparkSession)
    return out


# ---------------------------------------------------------------- sets of numbers as bits

def _with_bits(df: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """``df`` with ``has``: whether the bit of ``key`` is set in ``bits`` (run, words), which goes to all workers."""
    word = F.get("words", F.shiftright(key, 6).bitwiseAND(F.lit(RUN // 64 - 1)).cast("int"))
    bit = F.getbit(word, key.bitwiseAND(F.lit(63)).cast("int"))
    return (df.withColumn("run", F.shiftright(key, 15)).join(F.broadcast(bits), "run", "left")
            .withColumn("has", F.coalesce(bit == 1, F.lit(False))).drop("run", "words"))


def _bits(keys: DataFrame, key: Column) -> DataFrame:
    """``run, words``: for each run of ``RUN`` keys that has one of ``keys``, its bits in words of 64."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    set_ = keys.select(F.shiftright(key, 6).alias("word"), one.alias("m")).groupBy("word").agg(F.bit_or("m").alias("m"))
    set_ = saved(set_, "bit-words")
    runs = set_.select(F.shiftright("word", 9).alias("run")).distinct()
    zero = runs.select(F.explode(F.sequence(F.col("run") * (RUN // 64), F.col("run") * (RUN // 64) + (RUN // 64 - 1))).alias("word"),
                       F.lit(0).cast("long").alias("m"))
    both = set_.unionByName(zero).withColumn("run", F.shiftright("word", 9)).repartition("run")
    each = both.groupBy("run", "word").agg(F.bit_or("m").alias("m"))
    return saved(each.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("word", "m"))).alias("w")).select("run", F.col("w.m").alias("words")), "bits")


def _kept(df: DataFrame, uids: DataFrame, inside: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``uid`` is (not) in the written table ``uids``: one bit a line goes to all workers,
    up to ``RUNS`` runs; beyond, both sides are shuffled."""
    bits = _bits(uids, F.col("uid"))
    if bits.count() > RUNS:
        return df.join(uids.select("uid").distinct(), "uid", "left_semi" if inside else "left_anti")
    return _with_bits(df, F.col("uid"), bits).where(F.col("has") if inside else ~F.col("has")).drop("has")


def _likely(df: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``token`` is in the written table ``tokens`` (codes, without repeats), and few others."""
    runs = 8
    while runs < RUNS and runs * RUN < 64 * tokens.count():
        runs *= 2
    mask = F.lit(runs * RUN - 1)
    return _with_bits(df, F.col("token").bitwiseAND(mask), _bits(tokens, F.col("token").bitwiseAND(mask))).where("has").drop("has")


# ---------------------------------------------------------------- lines and tokens
# Computed arrays go through the outer forms of explode: for the inner ones Spark infers a filter
# on the array's size and would compute the array twice.

def _exploded(docs: DataFrame) -> DataFrame:
    """``row, doc_id, line, t, uid``; ``uid`` rises with ``row`` and ``line`` and is the same in every job, as ``row`` is."""
    lines = docs.select("row", "doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line", "t"))
    return lines.withColumn("uid", F.monotonically_increasing_id())


def _words(line: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a line; a split at one fixed character takes half the time of a pattern."""
    for space in "\t\x0b\x0c\r":
        line = F.replace(line, F.lit(space), F.lit(" "))
    return F.coalesce(F.array_remove(F.split(line, " "), ""), F.array().cast("array<string>"))


def _shingled(lines: DataFrame) -> DataFrame:
    """``t`` replaced by ``s``, distinct hashes of the runs of five words (none for shorter lines),
    and ``code``, the hash of all words (null for lines without words)."""
    own = [c for c in lines.columns if c != "t"]
    out = lines.select(*own, _words(F.lower("t")).alias("w"))
    out = out.select(*own, F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    starts = F.slice("h", F.lit(1), F.greatest(F.size("h") - (SHINGLE - 1), F.lit(0)))
    runs = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(F.col("h"), i + k) for k in range(1, SHINGLE)]))
    code = F.when(F.size("h") > 0, F.xxhash64("h"))
    return out.select(*own, F.array_distinct(runs).alias("s"), code.alias("code"))


def _wanted(docs: DataFrame, uids: DataFrame) -> DataFrame:
    """``uid, s`` of the lines of the written table ``uids`` alone."""
    return _shingled(_kept(_exploded(docs).select("uid", "t"), uids)).select("uid", "s")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("nil"), F.col("doc_id").alias("doc"), F.col("uid").alias("uid"))


def _prefix(ordered: Column, n: Column) -> Column:
    return F.slice(ordered, F.lit(1), n - F.floor((3 * n + 3) / 4).cast("int") + 1)


def _code(token: Column) -> Column:
    """40 bits of a token, for counts: shorter in a shuffle; tokens with one code count as one."""
    return token.bitwiseAND(F.lit((1 << 40) - 1))


def _by_rarity(lines: DataFrame, counts: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lines`` with the prefixes of rarity order, from those of hash order and the counts of their tokens;
    and tokens, among them all that several of these prefixes hold.

    Frequent tokens are found among the first tokens of all lines, then counted
    again among all tokens of the lines that have one; tokens are frequent by
    that second count.  A line without any of these in its prefix keeps it.
    """
    def having(codes: DataFrame) -> DataFrame:
        own = lines.select("uid", F.explode_outer("prefix").alias("token")).withColumn("token", _code(F.col("token")))
        return saved(own.join(small(codes, FEW), "token", "left_semi").select("uid").distinct(), "frequent-lines")

    def tokens_of(uids: DataFrame) -> DataFrame:
        out = _wanted(docs, uids).select("uid", F.explode_outer("s").alias("full"))
        return out.where(F.col("full").isNotNull()).withColumn("token", _code(F.col("full")))

    seen = saved(counts.where(F.col("k") >= FREQUENT).select("token"), "seen")
    if seen.isEmpty():
        return lines, counts.select("token")
    every = tokens_of(having(seen))
    frequent = saved(every.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= FREQUENT), "frequent")
    touched = having(frequent.select("token"))
    ranked = tokens_of(touched).join(small(frequent, FEW), "token", "left").groupBy("uid").agg(
        F.sort_array(F.collect_list(F.when(F.col("k").isNull(), F.col("full")))).alias("rare"),
        F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "full")))).alias("often"))
    ordered = F.concat("rare", F.col("often.full"))
    again = saved(ranked.select("uid", _prefix(ordered, F.size(ordered)).alias("prefix")), "by-rarity")
    same = _kept(lines, touched, inside=False)
    moved = _kept(lines, touched).drop("prefix").join(again, "uid")
    new = again.select(F.explode_outer("prefix").alias("token")).select(_code(F.col("token")).alias("token"))
    return same.unionByName(moved), saved(counts.select("token").unionByName(new).distinct(), "shared-codes")


# ---------------------------------------------------------------- join

def _similar_sizes(n1: Column, n2: Column) -> Column:
    return (4 * F.least(n1, n2)) >= (3 * F.greatest(n1, n2))


def _reaches(overlap: Column, n1: Column, n2: Column) -> Column:
    """The overlap that a similarity of 0.75 needs: three sevenths of both sizes."""
    return 7 * overlap >= 3 * (n1 + n2)


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Lines (uid) of the written pairs (uid, uid0) whose full sets reach the similarity."""
    ends = pairs.select(F.explode(F.array("uid", "uid0")).alias("uid"))
    sets = saved(_wanted(docs, ends), "line-sets").repartition("uid")      # one shuffle, used for both ends
    both = F.size(F.array_intersect("s", "s0"))
    return (pairs.join(sets, "uid").join(sets.select(F.col("uid").alias("uid0"), F.col("s").alias("s0")), "uid0")
            .where(4 * both >= 3 * (F.size("s") + F.size("s0") - both)).select("uid").distinct())


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``uid, row, line`` (from 0) of the lines of ``docs`` (row, doc_id, text) that match an earlier line."""
    n = F.size("s")
    every = saved(_shingled(_exploded(docs)).where(F.col("code").isNotNull()).select(
        "uid", "row", "doc_id", "line", "code", n.alias("n"), _prefix(F.sort_array("s"), n).alias("prefix")), "prefixes")

    # equal lines: all but the first go
    first = saved(every.groupBy("code").agg(F.min(_place()).alias("p")).select("p.uid"), "line-firsts")
    rest = _kept(every.where("n > 0").select("uid", "doc_id", "n", "prefix"), first)

    # first tokens that several lines have, in rarity order
    codes = rest.select(F.explode_outer("prefix").alias("token")).select(_code(F.col("token")).alias("token"))
    counts = saved(codes.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "often")
    ordered, codes = _by_rarity(rest, counts, docs)
    post = ordered.select("uid", "n", _place().alias("p"), F.posexplode_outer("prefix").alias("i", "token"))
    post = saved(_likely(post, codes), "postings")
    codes = post.select(_code(F.col("token")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    post = saved(_likely(post, saved(codes.where("k > 1").select("token"), "shared-codes")), "postings-2")

    # each line against the first line of each of its tokens
    lead = post.groupBy("token").agg(F.min(F.struct("p", "n", "i")).alias("f"))
    n1, n2 = F.col("n"), F.col("f.n")
    rest_of_both = F.least(n1 - F.col("i"), n2 - F.col("f.i")) + F.least(F.col("i"), F.col("f.i"))
    met = (post.join(lead, "token").where((F.col("p") > F.col("f.p")) & _similar_sizes(n1, n2) & _reaches(rest_of_both, n1, n2))
           .select("uid", F.col("f.p.uid").alias("uid0")).distinct())
    met = saved(met, "line-pairs")
    resolved = saved(_verified(met, docs), "line-near")

    # lines without a match so far against all earlier lines; the tokens that a
    # pair shares, and what is left behind the last of them, bound its overlap
    open_ = _kept(post, resolved, inside=False)
    before = post.select("token", F.col("n").alias("n0"), F.col("i").alias("i0"), F.col("p").alias("p0"))
    n1, n2, i1, i2 = (F.col(c) for c in ("n", "n0", "i", "i0"))
    shared = (open_.join(before, "token")
              .where((F.col("p") > F.col("p0")) & _similar_sizes(n1, n2)
                     & _reaches(F.least(n1 - i1, n2 - i2) + F.least(i1, i2), n1, n2))
              .groupBy("uid", F.col("p0.uid").alias("uid0"), "n", "n0")
              .agg(F.count(F.lit(1)).cast("int").alias("c"), F.max("i").alias("i"), F.max("i0").alias("i0"))
              .where(_reaches(F.col("c") + F.least(n1 - i1, n2 - i2) - 1, n1, n2)))
    more = saved(shared.select("uid", "uid0").join(met, ["uid", "uid0"], "left_anti"), "line-pairs-2")
    near = saved(resolved.unionByName(_verified(more, docs)), "line-near-2")
    where_ = every.select("uid", "row", "line")
    copies = _kept(where_, first, inside=False)
    return copies.unionByName(_kept(where_, near))


def _with_gone(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` (row, l: lines) with ``gone``, its lines of the written table ``gone`` (row, line), by a shuffle of ``rows``."""
    by_row = gone.groupBy("row").agg(F.collect_list("line").alias("gone"))
    return rows.join(by_row, "row", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))


def _with_gone_bits(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """The same from the bits of the lines that go, as far as they lie in the run of a document's first line and the next one.

    A document's lines are numbered here as ``_exploded`` does, and all but the first are dropped again.
    """
    place = F.when(F.col("l").isNotNull(), F.sequence(F.lit(0), F.size("l") - 1))
    out = rows.select("*", F.explode_outer(place).alias("line")).withColumn("uid", F.monotonically_increasing_id())
    out = out.where(F.coalesce("line", F.lit(0)) == 0).withColumn("run", F.shiftright("uid", 15))
    for name, step in (("here", 0), ("next", 1)):
        side = bits.select((F.col("run") - step).alias("run"), F.col("words").alias(name))
        out = out.join(F.broadcast(side), "run", "left")
    start = F.col("uid").bitwiseAND(F.lit(RUN - 1)).cast("int")

    def goes(i: Column) -> Column:
        at = start + i
        word = F.shiftright(at.bitwiseAND(F.lit(RUN - 1)), 6)
        held = F.when(at < RUN, F.get("here", word)).when(at < 2 * RUN, F.get("next", word))
        return F.coalesce(F.getbit(held, at.bitwiseAND(F.lit(63))) == 1, F.lit(False))
    known = (F.col("here").isNotNull() | F.col("next").isNotNull()) & F.col("l").isNotNull()
    gone = F.when(known, F.filter(F.sequence(F.lit(0), F.size("l") - 1), goes))
    return out.withColumn("gone", F.coalesce(gone, F.array().cast("array<int>"))).select(*rows.columns, "gone")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row of ``docs`` as struct ``_d`` with ``n_lines``, ``n_removed`` and ``kept_text``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"),
                       F.monotonically_increasing_id().alias("row"))
    flat = rows.select("row", F.col("_d").getField(id_col).alias("doc_id"), F.col("_d").getField(text_col).alias("text"))
    gone = saved(repeated_lines(flat), "lines-gone")
    rows = rows.withColumn("l", F.split(F.col("_d").getField(text_col), "\n"))
    bits = _bits(gone, F.col("uid"))
    # lines beyond the bits beside a document's first line (of documents with more than RUN lines) go by a shuffle of these
    deep = saved(gone.where(F.col("line") >= RUN).select(F.col("row").alias("uid")).distinct(), "long-documents")
    if bits.count() > RUNS:
        out = _with_gone(rows, gone)
    elif deep.isEmpty():
        out = _with_gone_bits(rows, bits)
    else:
        near = _with_gone_bits(rows, bits).withColumn("uid", F.col("row"))
        far = _with_gone(_kept(rows.withColumn("uid", F.col("row")), deep), gone)
        out = _kept(near, deep, inside=False).unionByName(far)
    out = out.withColumn("stay", F.when(F.size("gone") > 0, F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone"))))
    kept = F.when(F.col("stay").isNull(), F.col("_d").getField(text_col)).otherwise(
        F.array_join(F.transform("stay", lambda i: F.get(F.col("l"), i)), "\n"))
    return out.select("_d", F.coalesce(F.size("l"), F.lit(0)).cast("long").alias("n_lines"),
                      F.size("gone").cast("long").alias("n_removed"), kept.alias("kept_text"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; those that have no words left go.

    ``text`` is what stays, ``n_chars`` its length; other columns are unchanged.
    """
    out = deduplicated(docs).where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(
            F.col("_d.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[changed.get(c, F.col("_d").getField(c)).alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and removed lines of every document, and a digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select("_d.doc_id", "n_lines", "n_removed",
                                     F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op8_line_dedup": op8_line_dedup}
SQL = {"op8_line_dedup": r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, i, regexp_extract_all(lower(lines[i]), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), n AS (
  SELECT row_number() OVER (ORDER BY doc_id, i) AS id, doc_id, i, w FROM l WHERE len(w) >= 1
), s AS (
  SELECT DISTINCT id, array_to_string(list_slice(w, k, k + 4), ' ') AS g
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM n)
), z AS (
  SELECT id, count(*) AS size FROM s GROUP BY id
), p AS (
  SELECT a.id AS a, b.id AS b, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL
), gone AS (
  SELECT DISTINCT n.doc_id, n.i FROM p JOIN z x ON x.id = p.a JOIN z y ON y.id = p.b JOIN n ON n.id = p.b
  WHERE 4 * n_both >= 3 * (x.size + y.size - n_both)
), k AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN coalesce(text, '')
              ELSE array_to_string(list_transform(list_filter(range(1, len(lines) + 1),
                     lambda j: NOT list_contains(gone, j)), lambda j: lines[j]), chr(10)) END) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""}
