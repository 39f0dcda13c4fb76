"""Near-duplicates by a chosen-path set similarity join (operator 10).

A document's set is its distinct five-word shingles (lower-cased A-Z; the whole
sequence if it has fewer words).  Equal sets are one class.  Each class is
embedded as ``COORDINATES`` minwise tokens.  Every tree starts from all classes
and branches them by chosen tokens: a node picks each coordinate with
probability 1 / (similarity * coordinates), by a hash of its path, and its
members go to the child named by their token there.  So a similar pair is
expected to stay together in at least one child at every level.  Nodes of up to
``LEAF`` members are compared exhaustively, larger ones branch on, and what is
still larger at the last level is compared in blocks.  Independent trees are
repeated for recall.

Links are confirmed on full sets, in two passes so that a group of copies never
becomes all its pairs: first each class with its best earlier partner of all
nodes; the confirmed links give components; then what still shares a node
across components.  There, members of the largest component of a node are not
compared with one another, all others are compared with everybody.  The classes
that ask are dealt into packs, the classes they may be linked with are listed
once a pack, and packs are confirmed against the full sets block by block; only
links between different components leave a block, so rows grow with the members
and never with their pairs.

Defined cases: null, empty and word-less texts are linked with nothing; a null
document id takes part in links, is no component id, and is kept only when it
is alone; of repeated ids with linked texts one row is kept; an empty table
gives an empty result; other columns are ignored (``dedup_stage`` keeps them).
Sets are named by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from .common import BATCH_ROWS, TokenCodes, byte_words, chunks, n_shuffle, saved, small, table, window_codes
from .components import connected_components

SHINGLE = 5
PERCENT = 75          # links: 100 * intersection >= PERCENT * union
COORDINATES = 64
TREES = 16
LEVELS = 4
LEAF = 256
#: Least number of equal (8-bit) tokens of COORDINATES for a pair to be confirmed;
#: a pair of similarity 0.75 has 48 on average, with a deviation of 3.5.
LEAST_EQUAL = 31


# ---------------------------------------------------------------- sets

def shingle_set(text: str | None, codes: TokenCodes, width: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit codes of the distinct shingles."""
    words = byte_words(text, lower=True)
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(window_codes(codes.of(words), min(width, len(words))) + np.uint64(min(width, len(words))))


def _multipliers(n: int) -> np.ndarray:
    rng = np.random.default_rng(20240817)
    return rng.integers(1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _tokens(codes: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """One minwise token for each multiplier: the smallest product, its upper half."""
    least = np.full(len(odd), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(codes), 4096):
        np.minimum(least, (odd[:, None] * codes[None, at:at + 4096]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _set_fn(width: int):
    def build(batches):
        import xxhash
        codes, odd = TokenCodes(), _multipliers(COORDINATES)
        for batch in batches:
            rows_in, ids, texts = batch.column(0), batch.column(1), batch.column(2)
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                sizes, names, tokens = [], [], []
                for i in rows:
                    found = shingle_set(texts[i].as_py(), codes, width)
                    sizes.append(len(found))
                    names.append(xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63 if len(found) else None)
                    tokens.append(_tokens(found, odd).view(np.int32) if len(found) else None)
                at, n = rows[0], len(rows)
                yield pa.RecordBatch.from_arrays(
                    [rows_in.slice(at, n), ids.slice(at, n), batch.column(3).slice(at, n), pa.array(sizes, pa.int64()),
                     pa.array(names, pa.int64()), pa.array(tokens, pa.list_(pa.int32())),
                     pa.array([None if t is None else t.astype(np.uint8).tobytes() for t in tokens], pa.binary())],
                    names=["row", "doc_id", "mark", "n_shingles", "set", "tokens", "sketch"])
    return build


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                  row_col: str | None = None) -> DataFrame:
    """A row for each document: size and name of its set, its minwise tokens and their low bytes."""
    schema = StructType([
        StructField("row", LongType()), StructField("doc_id", docs.schema[id_col].dataType),
        StructField("mark", LongType()), StructField("n_shingles", LongType()), StructField("set", LongType()),
        StructField("tokens", ArrayType(IntegerType())), StructField("sketch", BinaryType())])
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    return docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("mark")).mapInArrow(_set_fn(width), schema)


def _full_fn(width: int):
    def build(batches):
        codes = TokenCodes()
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                sets = [shingle_set(texts[i].as_py(), codes, width).view(np.int64) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [names.slice(rows[0], len(rows)), pa.array(sets, pa.list_(pa.int64()))], names=["set", "shingles"])
    return build


# ---------------------------------------------------------------- trees

def _chosen(path, level: int, used):
    """Coordinates that a node picks, from a hash of its path."""
    odds = int((1 << 20) * 100 / (PERCENT * COORDINATES))
    return F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
                    lambda i: (F.pmod(F.xxhash64(path, F.lit(level), i), F.lit(1 << 20)) < odds)
                    & (F.call_function("shiftright", used, i).bitwiseAND(F.lit(1)) == 0))


def _root_choices(trees: int) -> list[tuple[int, int]]:
    """(tree, coordinate) pairs of all roots; each tree picks one at least."""
    rng = np.random.default_rng(7)
    picks = []
    for tree in range(trees):
        own = np.flatnonzero(rng.random(COORDINATES) < 100 / (PERCENT * COORDINATES)).tolist()
        picks += [(tree, c) for c in own or [int(rng.integers(COORDINATES))]]
    return picks


def tree_nodes(classes: DataFrame, trees: int = TREES, levels: int = LEVELS, leaf: int = LEAF) -> DataFrame:
    """``node, set, n``: the members of all nodes of two or more that are compared, and their number."""
    child = F.explode(F.array(*[F.struct(F.xxhash64(F.lit(t), F.lit(c), F.col("tokens")[c]).alias("node"),
                                         F.lit(1 << c if c < 63 else -(1 << 63)).cast("long").alias("used"))
                                for t, c in _root_choices(trees)]))
    now = classes.select("set", child.alias("x")).select("set", "x.node", "x.used")
    done = None
    for level in range(1, levels + 1):
        sizes = now.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        now = saved(now.join(sizes, "node"), f"tree-{level}")
        last = level == levels
        compare = (now if last else now.where(F.col("n") <= leaf)).select("node", "set", "n")
        done = compare if done is None else done.unionByName(compare)
        large = now.where(F.col("n") > leaf)
        if last or large.isEmpty():
            return done
        picked = (large.select("node", "used").distinct()
                  .withColumn("c", F.explode(_chosen(F.col("node"), level, F.col("used")))))
        now = (large.select("node", "set").join(picked, "node").join(classes.select("set", "tokens"), "set")
               .select("set", F.xxhash64("node", "c", F.get("tokens", F.col("c"))).alias("node"),
                       F.col("used").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("c"))).alias("used")))
    return done


# ---------------------------------------------------------------- candidates

def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal low bytes for all pairs of rows, in strips of bounded memory."""
    out = np.empty((len(a), len(b)), dtype=np.int16)
    for at in range(0, len(a), 32):
        out[at:at + 32] = (a[at:at + 32, None, :] == b[None, :, :]).sum(axis=2)
    return out


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), COORDINATES)


def _best_partner(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each member of each block the earlier member with the most equal tokens."""
    pdf = pdf.sort_values(["node", "block", "set"], ignore_index=True)
    sets, sketch = pdf["set"].to_numpy(), _sketches(pdf["sketch"])
    a, b, m = [], [], []
    for lo, hi in _slices(pdf, ["node", "block"]):
        if hi - lo < 2:
            continue
        same = _equal(sketch[lo:hi], sketch[lo:hi])
        same[np.triu_indices(hi - lo)] = -1          # earlier members only
        best = same.argmax(axis=1)
        most = same[np.arange(hi - lo), best]
        ok = most >= LEAST_EQUAL
        b.append(sets[lo:hi][ok])
        a.append(sets[lo:hi][best[ok]])
        m.append(most[ok])
    return pd.DataFrame({"a": np.concatenate(a) if a else [], "b": np.concatenate(b) if b else [],
                         "m": np.concatenate(m) if m else []}).astype({"a": "int64", "b": "int64", "m": "int64"})


def _slices(pdf: pd.DataFrame, columns: list[str]):
    """Start and end of each run of rows with equal ``columns``; ``pdf`` is sorted by them."""
    key = pdf[columns].to_numpy()
    cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
    return zip([0, *cut], [*cut, len(pdf)])


_MET = "main long, pack long, chunk long, sets array<long>"


def _met(pdf: pd.DataFrame) -> pd.DataFrame:
    """Members of different components that may be linked, as lists: who asks (chunk -1) and whom each pack meets."""
    pdf = pdf.sort_values(["node", "qb", "rb", "asks"], ignore_index=True)
    label, asks, pack = pdf["label"].to_numpy(), pdf["asks"].to_numpy(), pdf["pack"].to_numpy()
    sets, main, chunk = pdf["set"].to_numpy(), pdf["main"].to_numpy(), pdf["chunk"].to_numpy()
    sketch, found = _sketches(pdf["sketch"]), {}
    for lo, hi in _slices(pdf, ["node", "qb", "rb"]):
        mid = lo + int((~asks[lo:hi]).sum())
        if lo == mid or mid == hi:
            continue
        may = (_equal(sketch[mid:hi], sketch[lo:mid]) >= LEAST_EQUAL) & (label[mid:hi, None] != label[None, lo:mid])
        for one in np.unique(pack[mid:hi][may.any(axis=1)]).tolist():
            own = may & (pack[mid:hi] == one)[:, None]
            key = (int(main[lo]), one)
            found.setdefault((*key, -1), set()).update(sets[mid:hi][own.any(axis=1)].tolist())
            told = lo + np.flatnonzero(own.any(axis=0))
            for c in np.unique(chunk[told]).tolist():
                found.setdefault((*key, c), set()).update(sets[told[chunk[told] == c]].tolist())
    return pd.DataFrame([(*k, sorted(v)) for k, v in found.items()], columns=["main", "pack", "chunk", "sets"])


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between components, confirmed on full sets; one for each two components of a block."""
    pdf = pdf.sort_values(["main", "pack", "chunk", "block", "asks"], ignore_index=True)
    label, asks, sketch, found = pdf["label"].tolist(), pdf["asks"].to_numpy(), _sketches(pdf["sketch"]), []
    for lo, hi in _slices(pdf, ["main", "pack", "chunk", "block"]):
        mid = lo + int((~asks[lo:hi]).sum())
        if lo == mid or mid == hi:
            continue
        full = [frozenset(x.tolist()) for x in pdf["shingles"].iloc[lo:hi]]
        root: dict[int, int] = {}

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x
        same = _equal(sketch[mid:hi], sketch[lo:mid])
        for i, j in np.argwhere(same >= LEAST_EQUAL).tolist():
            x, y = top(label[mid + i]), top(label[lo + j])
            if x == y:
                continue
            a, b = full[mid - lo + i], full[j]
            both = len(a & b)
            if 100 * both >= PERCENT * (len(a) + len(b) - both):
                root[max(x, y)] = min(x, y)
                found.append((label[mid + i], label[lo + j]))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= PERCENT * union).select("a", "b")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES,
               row_col: str | None = None, leaf: int = LEAF) -> DataFrame:
    """``row, doc_id, n_shingles, component_id, kept`` of every document."""
    spark = docs.sparkSession
    rows = saved(document_sets(docs, id_col, text_col, SHINGLE, row_col), "sets")
    classes = saved(rows.where(F.col("set").isNotNull()).groupBy("set").agg(
        F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"), F.min("mark").alias("mark")), "classes")
    nodes = saved(tree_nodes(classes, trees, leaf=leaf).join(classes.select("set", "sketch"), "set"), "nodes")

    # first pass: the best earlier partner of each class, nodes cut into blocks of ``leaf`` members
    n_tasks = max(1, nodes.count() // 20_000, n_shuffle(spark))
    blocks = F.ceil(F.col("n") / leaf)
    first = (nodes.withColumn("block", F.pmod(F.xxhash64("set"), blocks).cast("long"))
             .withColumn("task", F.pmod(F.xxhash64("node", "block"), F.lit(n_tasks)).cast("int"))
             .groupBy("task").applyInPandas(_best_partner, "a long, b long, m long"))
    forest = saved(first.groupBy("b").agg(F.max_by("a", F.struct("m", "a")).alias("a")).select("a", "b"), "partners")
    label = connected_components(_confirmed(forest, _full_sets(
        docs, classes, forest.select(F.explode(F.array("a", "b")).alias("set")), id_col, text_col)))
    label = saved(label, "labels-1")

    # second pass: what still shares a node across components
    seen = (nodes.join(label.withColumnRenamed("node", "set"), "set", "left")
            .withColumn("label", F.coalesce("label", "set")))
    per = seen.groupBy("node", "label").agg(F.count(F.lit(1)).alias("k"))
    per = per.groupBy("node").agg(F.count(F.lit(1)).alias("labels"), F.sum("k").alias("members"),
                                  F.max_by("label", F.struct("k", "label")).alias("main"), F.max("k").alias("k"))
    per = per.where("labels > 1").select(
        "node", "main", F.ceil((F.col("members") - F.col("k")) / leaf).cast("int").alias("nq"),
        F.ceil(F.col("members") / leaf).cast("int").alias("nr"))
    open_nodes = saved(seen.select("node", "set", "label", "sketch").join(per, "node"), "open-nodes")
    # a component's members are listed in chunks of bounded size
    chunks_of = open_nodes.select("main", "set").distinct().groupBy("main").agg(
        F.ceil(F.count(F.lit(1)) / (16 * leaf)).cast("int").alias("chunks"))
    asking = open_nodes.where(F.col("label") != F.col("main"))
    packs = asking.select("main", "set").distinct().groupBy("main").agg(
        F.ceil(F.count(F.lit(1)) / leaf).cast("int").alias("packs"))
    spread = F.xxhash64("set", F.lit(11))
    ask = (asking.join(packs, "main")
           .withColumn("pack", F.pmod(F.xxhash64("set", F.lit(12)), F.col("packs")).cast("long")).drop("packs")
           .withColumn("qb", F.pmod(spread, F.col("nq")).cast("int"))
           .withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("nr") - 1))).withColumn("asks", F.lit(True)))
    tell = (open_nodes.join(chunks_of, "main")
            .withColumn("chunk", F.pmod(F.xxhash64("set", F.lit(13)), F.col("chunks")).cast("long")).drop("chunks")
            .withColumn("rb", F.pmod(spread, F.col("nr")).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).withColumn("asks", F.lit(False))
            .withColumn("pack", F.lit(-1).cast("long")))
    cols = ["node", "qb", "rb", "main", "pack", "chunk", "asks", "set", "label", "sketch"]
    met = (ask.withColumn("chunk", F.lit(-1).cast("long")).select(cols).unionByName(tell.select(cols))
           .withColumn("task", F.pmod(F.xxhash64("node", "qb", "rb"), F.lit(n_tasks)).cast("int"))
           .groupBy("task").applyInPandas(_met, _MET))
    met = saved(met.groupBy("main", "pack", "chunk").agg(
        F.array_distinct(F.flatten(F.collect_list("sets"))).alias("sets")), "met")
    # packs against the classes they met, in blocks
    told = met.where("chunk >= 0").withColumn("width", F.ceil(F.size("sets") / leaf).cast("int"))
    tells = (told.select("main", "pack", "chunk", "width", F.explode("sets").alias("set"), F.lit(False).alias("asks"))
             .withColumn("block", F.pmod(spread, F.col("width")).cast("int")))
    asks = (met.where("chunk < 0").select("main", "pack", F.explode("sets").alias("set"), F.lit(True).alias("asks"))
            .join(told.select("main", "pack", "chunk", "width"), ["main", "pack"])
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("width") - 1))))
    full = _full_sets(docs, classes, met.select(F.explode("sets").alias("set")), id_col, text_col)
    about = (classes.select("set", "sketch").join(full, "set")
             .join(label.withColumnRenamed("node", "set"), "set", "left").withColumn("label", F.coalesce("label", "set")))
    dealt = saved(asks.drop("width").unionByName(tells.drop("width")), "packs")
    n_blocks = max(n_shuffle(spark), dealt.count() // 2_000)
    links = (dealt.join(about, "set")
             .withColumn("task", F.pmod(F.xxhash64("main", "pack", "chunk", "block"), F.lit(n_blocks)).cast("int"))
             .groupBy("task").applyInPandas(_links, "a long, b long"))

    # components of components
    over = connected_components(saved(links.distinct(), "links"))
    every = classes.select("set").join(label.withColumnRenamed("node", "set"), "set", "left").select(
        "set", F.coalesce("label", "set").alias("label"))
    every = every.join(over.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left").select(
        "set", F.coalesce("top", "label").alias("label"))
    return _result(rows, every)


def _full_sets(docs: DataFrame, classes: DataFrame, named: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Full sets of the classes in ``named``, built again from one text of each."""
    wanted = saved(classes.select("set", "mark").join(named.distinct(), "set", "left_semi"), "wanted")
    texts = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    texts = texts.join(small(wanted), "mark").select("set", "text")
    schema = StructType([StructField("set", LongType()), StructField("shingles", ArrayType(LongType()))])
    full = texts.mapInArrow(_full_fn(SHINGLE), schema)
    # equal texts share a mark: one of them is enough
    return saved(full.groupBy("set").agg(F.first("shingles").alias("shingles")), "full-sets")


def _result(rows: DataFrame, labels: DataFrame) -> DataFrame:
    id_type = rows.schema["doc_id"].dataType
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("row").alias("r"))
    of = saved(rows.where(F.col("set").isNotNull()).select("row", "doc_id", "n_shingles", "set")
               .join(labels, "set").drop("set"), "labelled")
    least = of.groupBy("label").agg(F.min(place).alias("least"))
    linked = of.join(least, "label").select(
        "row", "doc_id", "n_shingles", F.col("least.d").alias("component_id"),
        (F.col("row") == F.col("least.r")).alias("kept"))
    empty = rows.where(F.col("set").isNull()).select(
        "row", "doc_id", "n_shingles", F.col("doc_id").cast(id_type).alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(empty)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, with its own columns.

    ``docs`` is a table read from files: its rows are numbered by their place
    in the scan, which is the same in every job.
    """
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"),
                           F.monotonically_increasing_id().alias("_row"))
    flat = numbered.select("_row", F.col("_d.doc_id").alias("doc_id"), F.col("_d.text").alias("text"))
    dropped = saved(components(flat, row_col="_row").where(~F.col("kept")).select(F.col("row").alias("_row")), "dropped")
    return numbered.join(small(dropped), "_row", "left_anti").select("_d.*")


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document."""
    return components(table(spark, sf_dir, "documents")).drop("row")


QUERIES = {"op10_chosen_path": op10_chosen_path}
SQL: dict = {}
