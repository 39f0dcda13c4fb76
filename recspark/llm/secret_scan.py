"""Secret scans with a randomness test battery (operator 2), DataFrame functions only.

Three pattern kinds give the base spans.  Beside them, every run of 20 and more
characters that could be encoded bytes is a candidate of kind ``random``; runs
end at each ``=`` that is not padding (as in NAME=value), and a run with signs
of both base64 alphabets, which fits no encoding, gives its longest parts in
each.  The encoding is inferred from the characters, and three tests look at a
candidate as a sequence over that alphabet: chi-squared uniformity, Wald-Wolfowitz runs about
the middle of the alphabet, and lag-one serial correlation.

A candidate is a finding when none of the tests rejects randomness and its
chi-squared value is too *small* for text: under the hypothesis "text" the
statistic is non-central, with a non-centrality that grows with the length, so
short strings need to be more even than they can be.  These p-values go through
the Benjamini-Hochberg procedure within strata of encoding and length (powers
of two) over the whole corpus; the step-up works on a histogram of the p-values
with tenths of decades as bins, rounded up, so it needs no global order.

Defined cases: null and empty texts have no spans; repeated rows get a row
each; an empty table gives an empty result; findings that overlap a base span
are dropped, base spans never are; other columns are ignored.  Rows are
numbered in the scan of ``docs``.  Normal tails use the logistic approximation
of the error function (absolute error below 2e-4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, small, table

KINDS = ("assign", "access", "hex", "random")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Patterns of the kinds (fixed values); lengths that follow from greedy runs are part of the pattern.
ASSIGN = ("(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


def _encoded(chars: str) -> str:
    """Runs of 20 and more of ``chars``, padding included; a ``=`` is padding if no further character follows."""
    end = f"(?![={chars}])"
    short = "|".join(f"[{chars}]{{{20 - k}}}={{{k},}}+{end}" for k in range(1, 5))
    return f"[{chars}]{{20,}}+(?:=++{end})?|{short}"


ENCODED = _encoded("A-Za-z0-9+/_-")
#: The alphabets that a run of both base64 kinds is cut into.
PARTS = (_encoded("A-Za-z0-9+/"), _encoded("A-Za-z0-9_-"))
MIN_VALUE = 6

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings in the order in which they are inferred: name, characters, alphabet, and the chance that two
#: characters of text agree in it (parameter of the hypothesis "text"; English letters agree with 0.066).
ENCODINGS = [
    ("hex", "[0-9a-f]+", _DIGITS + "abcdef", 0.12),
    ("hex-upper", "[0-9A-F]+", _DIGITS + "ABCDEF", 0.12),
    ("letters", "[a-z]+", _LOWER, 0.066),
    ("base32", "[A-Z2-7]+", _UPPER + "234567", 0.066),
    ("base36", "[a-z0-9]+", _DIGITS + _LOWER, 0.066),
    ("base62", "[A-Za-z0-9]+", _DIGITS + _UPPER + _LOWER, 0.066),
    ("base64", "[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/", 0.066),
    ("base64url", "[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_", 0.066),
]
#: |z| beyond which a test rejects randomness, and the false-discovery rate.
REJECT = 3.29
FDR = 0.01


# ---------------------------------------------------------------- spans

def _matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern with the lengths of the stretches before them (null without a match)."""
    found = F.regexp_extract_all(text, F.lit(f"(?:{pattern})"), F.lit(0))
    before = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    return F.when(text.rlike(pattern), F.arrays_zip(before.alias("before"), found.alias("found")))


def _placed(rows: DataFrame, key: list[str], text: str, patterns) -> DataFrame:
    """``key, kind, start, end, token`` of the matches of each pattern; kinds are numbers in the order of ``patterns``."""
    by_kind = F.array(*[F.struct(F.lit(k).alias("kind"), _matches(F.col(text), p).alias("m"))
                        for k, p in enumerate(patterns)])
    each = (rows.select(*key, F.explode(by_kind).alias("x")).where(F.col("x.m").isNotNull())
            .select(*key, "x.kind", F.posexplode("x.m").alias("i", "m"))
            .select(*key, "kind", "i", F.col("m.before").alias("before"), F.col("m.found").alias("token"))
            .where(F.col("token").isNotNull()))                       # the last stretch has no match after it
    size = F.length("token")
    upto = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return each.withColumn("end", F.sum(F.col("before") + size).over(upto)).withColumn("start", F.col("end") - size)


def spans(rows: DataFrame) -> DataFrame:
    """``_row, kind, start, end, token`` of all kinds; kinds are numbers in the order of ``KINDS``."""
    placed = _placed(rows, ["_row"], "text", (ASSIGN, ACCESS, HEX, ENCODED))
    value = F.length(F.regexp_extract("token", ASSIGN, 2))
    return placed.where((F.col("kind") != 0) | (value >= MIN_VALUE)).select("_row", "kind", "start", "end", "token")


def candidates(found: DataFrame) -> DataFrame:
    """Spans of kind ``random``, those with signs of both base64 alphabets as their longest parts in each."""
    runs = found.where("kind = 3").drop("kind")
    mixed = F.col("token").rlike("[+/]") & F.col("token").rlike("[_-]")
    parts = _placed(runs.where(mixed).select("_row", F.col("start").alias("at"), F.col("token").alias("run")),
                    ["_row", "at"], "run", PARTS)
    parts = parts.select("_row", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"), "token")
    return runs.where(~mixed).unionByName(parts.distinct())


# ---------------------------------------------------------------- randomness tests

def _normal(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.070565664 * z * z * z)))


def _by_encoding(value) -> Column:
    out = None
    for enc in ENCODINGS:
        cond = F.col("core").rlike(f"^{enc[1]}$")
        out = F.when(cond, F.lit(value(enc))) if out is None else out.when(cond, F.lit(value(enc)))
    return out


def _count(of: str, what: Column | str, size: int) -> Column:
    what = F.lit(what) if isinstance(what, str) else what
    return (F.length(of) - F.length(F.replace(F.col(of), what, F.lit("")))) / size


def battery(found: DataFrame) -> DataFrame:
    """Add encoding, length ``n``, the three statistics as z values, and ``p``, the p-value of "text"."""
    out = found.withColumn("core", F.regexp_replace("token", "=+$", ""))
    out = out.withColumns({"encoding": _by_encoding(lambda e: e[0]), "alphabet": _by_encoding(lambda e: e[2]),
                           "agree": _by_encoding(lambda e: e[3]), "n": F.length("core").cast("double")})
    out = out.where(F.col("encoding").isNotNull() & (F.col("n") >= 16))
    symbols = F.filter(F.split("alphabet", ""), lambda c: c != "")
    out = out.withColumn("symbols", symbols).withColumn("a", F.size("symbols").cast("double"))
    # uniformity
    out = out.withColumn("counts", F.transform("symbols", lambda c: (F.length(F.col("core")) - F.length(
        F.replace(F.col("core"), c, F.lit("")))).cast("double")))
    squares = F.aggregate("counts", F.lit(0.0), lambda s, c: s + c * c)
    out = out.withColumn("chi2", F.col("a") / F.col("n") * squares - F.col("n"))
    free = F.col("a") - 1
    out = out.withColumn("z_chi", (F.pow(F.col("chi2") / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
    # runs about the middle of the alphabet
    half = F.floor(F.col("a") / 2).cast("int")
    mask = F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), F.size("symbols") - half))
    out = out.withColumn("halves", F.call_function("translate", F.col("core"), F.col("alphabet"), mask))
    ones = _count("halves", "1", 1)
    runs = 1 + _count("halves", "01", 2) + _count("halves", "10", 2)
    mean = 2 * ones * (F.col("n") - ones) / F.col("n") + 1
    spread = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    out = out.withColumn("z_runs", F.when(spread > 0, (runs - mean) / F.sqrt(spread)).otherwise(F.lit(99.0)))
    # lag-one serial correlation of the places in the alphabet
    out = out.withColumn("values", F.transform(F.filter(F.split("core", ""), lambda c: c != ""),
                                               lambda c: F.instr(F.col("alphabet"), c).cast("double")))
    total = F.aggregate("values", F.lit(0.0), lambda s, v: s + v)
    out = out.withColumn("mean", total / F.col("n"))
    out = out.withColumn("centred", F.transform("values", lambda v: v - F.col("mean")))
    later = F.slice("centred", F.lit(2), F.size("centred") - 1)
    cross = F.aggregate(F.zip_with(F.slice("centred", F.lit(1), F.size("centred") - 1), later, lambda x, y: x * y),
                        F.lit(0.0), lambda s, v: s + v)
    power = F.aggregate("centred", F.lit(0.0), lambda s, v: s + v * v)
    out = out.withColumn("z_serial", F.when(power > 0, (cross / power + 1 / F.col("n")) * F.sqrt("n")).otherwise(F.lit(99.0)))
    # text: non-central chi-squared, by its first two moments
    extra = F.col("n") * (F.col("a") * F.col("agree") - 1)
    p = _normal((F.col("chi2") - free - extra) / F.sqrt(2 * free + 4 * extra))
    random = (F.abs("z_chi") < REJECT) & (F.abs("z_runs") < REJECT) & (F.abs("z_serial") < REJECT)
    return out.withColumn("p", F.when(random, F.greatest(p, F.lit(1e-30))).otherwise(F.lit(1.0))).drop(
        "symbols", "counts", "halves", "values", "mean", "centred", "alphabet", "agree")


def discoveries(tested: DataFrame, rate: float = FDR) -> DataFrame:
    """Rows that the step-up procedure accepts within their stratum of encoding and length."""
    binned = tested.withColumns({"octave": F.floor(F.log2("n")).cast("int"),
                                 "bin": F.floor(-10 * F.log10("p")).cast("int")})
    counts = binned.groupBy("encoding", "octave", "bin").agg(F.count(F.lit(1)).alias("k"))
    stratum = Window.partitionBy("encoding", "octave")
    smaller = stratum.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    steps = counts.select("encoding", "octave", "bin", F.sum("k").over(smaller).alias("upto"), F.sum("k").over(stratum).alias("m"))
    cut = (steps.where(F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("m") / F.col("upto") <= rate)
           .groupBy("encoding", "octave").agg(F.min("bin").alias("cut")))
    # at most encodings x octaves rows
    return binned.join(F.broadcast(cut), ["encoding", "octave"]).where(F.col("bin") >= F.col("cut"))


# ---------------------------------------------------------------- documents

def _joined(list_: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(list_, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FDR) -> DataFrame:
    """One row a document: counts of the base kinds, a digest of the base spans, and all spans."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    found = saved(spans(rows), "secret-spans")
    random = discoveries(battery(saved(candidates(found), "secret-candidates")), rate).select(
        "_row", F.lit(3).alias("kind"), "start", "end")
    every = found.where("kind < 3").select("_row", "kind", "start", "end").unionByName(random)
    of = every.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    of = saved(of.select("_row", "s", F.filter("s", lambda x: x["kind"] < 3).alias("base")), "secret-rows")
    out = rows.drop("text").join(small(of), "_row", "left")
    none = F.lit("")
    stay = F.filter("s", lambda x: (x["kind"] < 3) | ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))

    def number(kind: int) -> Column:
        return F.coalesce(F.size(F.filter("base", lambda x: x["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{KINDS[kind]}")
    return out.select("doc_id", number(0), number(1), number(2),
                      F.sha2(F.coalesce(_joined(F.col("base")), none), 256).alias("base_sha256"),
                      F.coalesce(_joined(stay), none).alias("spans"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets(table(spark, sf_dir, "documents"))


QUERIES = {"op2_secret_scan": op2_secret_scan}
SQL: dict = {}
