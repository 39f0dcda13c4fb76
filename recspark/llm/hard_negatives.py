"""Hard-negative mining with Kronecker-packed products (operator 12).

Scores are exact integer inner products of scaled vectors.  ``packed_products``
computes them the packed way: both sides are biased to be non-negative, the
components of several candidates are laid into separate fields of one wide
integer, every anchor component multiplies that integer once, and the summed
words are cut into their fields again; the biases come off by row and column
sums.  A field is as wide as a proven bound on any score needs.  The wide
integer is the 53-bit whole number of a double where two fields fit (the
products then run through BLAS and stay exact), a 64-bit word where one does,
and a Python integer of any width beyond.

Plan: rows and anchors are dealt into blocks by a hash of their id, and every
pair of an anchor block and a row block is one bounded task (a stated query set
against all rows, in blocks).  The first pass scores rows of the anchor's own
label and finds its positives; the second scores the other labels against the
windows that the positives open.  Only the best few of a block leave a task; a
window function merges them.  A label that a third of all rows hold is spread
over all blocks like any other.

Defined cases: rows with a null id, a null label, a null vector or any null or
non-finite component take no part; vectors of different lengths compare as if
the shorter ended in zeros; of rows with one id the least by (label, vector)
counts; anchors without another row of their label give no rows; a positive
below zero opens an empty window; scores beyond 2**53 in size are held there;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_shuffle, saved, table

#: A block holds this many rows, or anchors, at most on average; with fewer rows in all, blocks shrink to ``LEAST_ROWS``.
BLOCK_ROWS = 16_384
LEAST_ROWS = 1024
#: Scores that one tile of a task holds.
TILE = 1 << 20
_HELD = 1 << 53


# ---------------------------------------------------------------- products

def _word(width: int, narrow: bool) -> tuple[type, int]:
    """Type of the wide integer, and how many fields of ``width`` bits one holds."""
    if narrow and 2 * width <= 53:
        return np.float64, 53 // width
    if narrow and width <= 64:
        return np.uint64, 64 // width
    return object, 4


def packed_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, ``len(anchors) x len(rows)``: int64, or Python integers beyond it."""
    if not len(anchors) or not len(rows) or not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)), dtype=np.int64)
    narrow = anchors.dtype != object and rows.dtype != object
    if not narrow:
        anchors, rows = anchors.astype(object), rows.astype(object)
    low_a, low_r = anchors.min(axis=0), rows.min(axis=0)
    a, r = anchors - low_a, rows - low_r
    width = max(1, sum(int(x) * int(y) for x, y in zip(a.max(axis=0), r.max(axis=0))).bit_length())
    word, fields = _word(width, narrow)
    words = -(-len(r) // fields)
    packed = np.zeros((words, r.shape[1]), dtype=word)
    for f in range(fields):                                   # row f * words + w is field f of word w
        part = r[f * words:(f + 1) * words]
        packed[:len(part)] += part.astype(word) * np.array(1 << f * width, dtype=word)
    total = a.astype(word) @ packed.T
    scores = np.empty((len(a), fields * words), dtype=word)
    for f in reversed(range(fields)):                         # cut from the top field down
        one = scores[:, f * words:(f + 1) * words]
        if word is np.float64:
            np.floor(np.multiply(total, 2.0 ** -(f * width), out=one), out=one)
            total -= one * 2.0 ** (f * width)
        else:
            one[:] = total >> np.array(f * width, dtype=word) & np.array((1 << width) - 1, dtype=word)
    scores = scores[:, :len(r)].astype(np.int64 if narrow else object)
    scores += (a @ low_r)[:, None]
    scores += ((r @ low_a) + low_a @ low_r)[None, :]
    return scores


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles, exactly: int64 while biased scores stay below 2**62, Python integers beyond."""
    top = float(np.abs(vectors).max(initial=0.0)) * scale + 1
    if 4 * top * top * max(1, vectors.shape[-1]) < 2.0 ** 62:
        return np.floor(vectors * float(scale)).astype(np.int64)

    def one(x: float) -> int:
        n, d = float(x).as_integer_ratio()
        return scale * n // d
    return np.array([[one(x) for x in v] for v in vectors.tolist()], dtype=object).reshape(vectors.shape)


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    s = packed_products(anchors, rows)
    return np.clip(s, -_HELD, _HELD).astype(np.int64) if s.dtype == object or abs(s).max(initial=0) > _HELD else s


# ---------------------------------------------------------------- one pair of blocks

def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Ragged lists as one matrix of doubles, ended by zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _block(t: pa.Table, dims: int, scale: int):
    """Ids, labels, whole-number vectors and places in the table, one row an id, by ascending id."""
    ids, labels = (t.column(c).to_numpy() for c in ("vec_id", "label"))
    matrix = _matrix(t.column("vec"), dims)
    order = np.lexsort((labels, ids))
    again = ids[order][1:] == ids[order][:-1]
    if again.any():
        order = np.lexsort((*matrix.T[::-1], labels, ids))
        again = ids[order][1:] == ids[order][:-1]
    order = order[np.concatenate([[True], ~again])] if len(order) else order
    return ids[order], labels[order], scaled(matrix[order], scale), order


def _dims(*tables: pa.Table) -> int:
    return max((int(np.diff(t.column("vec").combine_chunks().offsets.to_numpy()).max(initial=0)) for t in tables if t.num_rows),
               default=0)


def _first_of(owner: np.ndarray, most: int) -> np.ndarray:
    """Marks the first ``most`` of each run of equal owners."""
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.empty(0, dtype=np.int64)
    place = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    return place < most


def _positive_fn(most: int, scale: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def fn(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and anchors.num_rows:
            dims = _dims(rows, anchors)
            r_id, r_label, r_vec, _ = _block(rows, dims, scale)
            a_id, a_label, a_vec, _ = _block(anchors, dims, scale)
            for label in np.unique(a_label):
                mine, theirs = np.flatnonzero(a_label == label), np.flatnonzero(r_label == label)
                if not len(theirs):
                    continue
                step = max(1, TILE // len(theirs))
                for at in range(0, len(mine), step):
                    part = mine[at:at + step]
                    s = _scores(a_vec[part], r_vec[theirs])
                    s = np.where(a_id[part][:, None] == r_id[theirs][None, :], -_HELD - 1, s)       # itself
                    k = max(0, len(theirs) - most)
                    bar = np.partition(s, k, axis=1)[:, k]
                    i, j = np.nonzero((s >= bar[:, None]) & (s >= -_HELD))
                    value = s[i, j]
                    by = np.lexsort((j, -value, i))
                    by = by[_first_of(i[by], most)]
                    for o, x in zip(out, (a_id[part][i[by]], r_id[theirs][j[by]], value[by])):
                        o.append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(o) if o else [], pa.int64()) for o in out], schema=schema)
    return fn


def _negative_fn(most: int, low: int, high: int, scale: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                        ("negative_id", pa.int64()), ("negative_score", pa.int64())])

    def fn(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[] for _ in schema]
        if rows.num_rows and anchors.num_rows:
            dims = _dims(rows, anchors)
            r_id, r_label, r_vec, _ = _block(rows, dims, scale)
            a_id, a_label, a_vec, place = _block(anchors, dims, scale)
            positives = anchors.column("positives").combine_chunks().take(pa.array(place))
            n_pos = np.diff(positives.offsets.to_numpy())
            flat = positives.flatten()
            p_id, p_score = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            p_of = np.repeat(np.arange(len(a_id)), n_pos)
            p_place = np.arange(len(p_of)) - np.repeat(np.cumsum(n_pos) - n_pos, n_pos)
            score_of = np.full((len(a_id), int(n_pos.max(initial=0))), -1, dtype=np.int64)
            id_of = np.zeros_like(score_of)
            score_of[p_of, p_place], id_of[p_of, p_place] = p_score, p_id
            open_ = score_of >= 0                            # a positive below zero, or none, opens no window
            top = np.where(open_, score_of, -1).max(axis=1, initial=-1)
            least = np.where(open_, score_of, _HELD).min(axis=1, initial=_HELD)
            step = max(1, TILE // len(r_id))
            for at in range(0, len(a_id), step):
                here = slice(at, at + step)
                s = _scores(a_vec[here], r_vec)
                i, j = np.nonzero((high * s >= low * least[here][:, None]) & (s <= top[here][:, None])
                                  & (a_label[here][:, None] != r_label[None, :]))
                value = s[i, j]
                by = np.lexsort((j, -value, i))
                i, j, value = i[by] + at, j[by], value[by]
                for k in range(score_of.shape[1]):
                    inside = np.flatnonzero(open_[i, k] & (low * score_of[i, k] <= high * value) & (value <= score_of[i, k]))
                    inside = inside[_first_of(i[inside], most)]
                    a = i[inside]
                    for o, x in zip(out, (a_id[a], id_of[a, k], score_of[a, k], r_id[j[inside]], value[inside])):
                        o.append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(o) if o else [], pa.int64()) for o in out], schema=schema)
    return fn


# ---------------------------------------------------------------- over a table

def usable(rows: DataFrame, id_col: str, label: Column, vec_col: str) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
            .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))


def _dealt(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Both sides, each copied to the blocks of the other."""
    def block(n):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def others(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    r = rows.select("*", block(n_rows).alias("_r"), others(n_anchors).alias("_a"))
    a = anchors.select("*", block(n_anchors).alias("_a"), others(n_rows).alias("_r"))
    return r.groupBy("_r", "_a").cogroup(a.groupBy("_r", "_a"))


def _best(df: DataFrame, keys: list, score: str, other: str, most: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(other))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
                   high: int = 100, scale: int = 256) -> DataFrame:
    """Best negatives of each anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` are (vec_id, label, vec) of ``usable``.  The
    positives of an anchor are its ``n_positives`` best other rows of the same
    label; negatives are the best ``n_negatives`` rows of other labels with
    ``low * positive <= high * negative <= high * positive``.
    """
    spark = rows.sparkSession
    n, m = rows.count(), anchors.count()
    if not n or not m:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    n_rows = max(-(-n // BLOCK_ROWS), min(n_shuffle(spark), -(-n // LEAST_ROWS)))
    n_anchors = -(-m // BLOCK_ROWS)
    near = _dealt(rows, anchors, n_rows, n_anchors).applyInArrow(
        _positive_fn(n_positives, scale), "anchor_id long, positive_id long, positive_score long")
    near = _best(near, ["anchor_id"], "positive_score", "positive_id", n_positives)
    lists = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    known = saved(anchors.join(lists, "vec_id"), "positives")
    found = _dealt(rows, known, n_rows, n_anchors).applyInArrow(
        _negative_fn(n_negatives, low, high, scale),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    found = _best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                        "positive_score", "negative_score")


ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector against all vectors."""
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", moved, "embedding")
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHOR_EVERY == 0))


QUERIES = {"op12_hard_negatives": op12_hard_negatives}

SQL = {"op12_hard_negatives": f"""
    WITH v AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (CAST(label AS BIGINT) + 1) % {LABELS} ELSE label END AS BIGINT) AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                 CAST(list_dot_product(a.e, r.e) AS BIGINT) AS score
          FROM v a JOIN v r ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> r.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
           positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
    QUALIFY row_number() OVER w <= 5"""}
