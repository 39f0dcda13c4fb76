"""Document fingerprints from prefix polynomial hashes (operator 13).

A text is the sequence of its code points.  ``prefix_arrays`` holds, for two
bases modulo ``2**31 - 1``, the running sums ``S[i] = sum (c[j] + 1) * B**j``
over ``j < i``.  The code of any span is ``(S[j] - S[i]) * B**-i``: two spans
are equal when their codes are, wherever they stand, and the longest common
extension of two places is found by binary search over span lengths
(``PrefixHashes``, and ``shared_ends`` for a table of text pairs).

The fingerprint of a text is read off those arrays and off nothing else:

* its length and the code of the whole text;
* the codes of its prefixes and of its suffixes at the lengths of a fixed
  geometric grid - a sampled prefix array, so that two fingerprints alone give
  the common prefix and suffix of their texts by binary search on the grid;
* for each of ``BINS`` bins the least mixed code of its spans of ``SPAN`` code
  points, which estimates the share of equal spans.

``likeness`` is the larger of the share of common ends and the share of equal
spans, between 0 and 1, and 1 for equal fingerprints.

``chained_fingerprints`` also needs each document's successor in descending id
order.  Documents are dealt by ranges of (id, text hash), whose bounds come
from the ids alone (one row a range reaches the driver); the first document of
each range is sent to the range before it as well.  Whole texts are shuffled
once, and every task streams its range in order with one document in hand.

Defined cases: a null text is the empty text, whose fingerprint is that of the
length 0; two empty texts are equal (likeness 1), an empty and another text
share nothing (0); null ids come last in the order; documents of equal id
follow by text hash, equal rows in any order (they are interchangeable); a
single document is its own successor; an empty table gives an empty result;
texts beyond ``SEGMENT`` code points are read in segments of that size; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import n_shuffle, scramble, table

#: Modulus and bases of the polynomials (fixed values).
MODULUS = (1 << 31) - 1
BASES = (1_103_515_245, 826_366_247)
SPAN = 20
BINS = 64
#: Code points that one prefix array holds at most; longer texts are read in segments.
SEGMENT = 1 << 18

_P = np.uint64(MODULUS)
_SHIFT = np.uint64(31)


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo 2**31 - 1 for any unsigned 64-bit ``x``."""
    x = (x & _P) + (x >> _SHIFT)
    x = (x & _P) + (x >> _SHIFT)
    x = (x & _P) + (x >> _SHIFT)
    return x - _P * (x >= _P)


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mod(a + _P - b)


class _Powers:
    """Powers of a base and of its inverse, grown by doubling up to what was asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, MODULUS)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> "_Powers":
        while len(self.up) <= n:
            size = len(self.up)
            self.up = np.concatenate([self.up, _mod(self.up * np.uint64(pow(self.base, size, MODULUS)))])
            self.down = np.concatenate([self.down, _mod(self.down * np.uint64(pow(self.inverse, size, MODULUS)))])
        return self


_POWERS = tuple(_Powers(b) for b in BASES)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def prefix_arrays(points: np.ndarray) -> list[np.ndarray]:
    """One running sum a base, of length ``len(points) + 1``, modulo 2**31 - 1."""
    n, out = len(points), []
    one = points + np.uint64(1)
    for powers in _POWERS:
        term = one * powers.reach(n).up[:n]                   # below 2**53
        term = (term & _P) + (term >> _SHIFT)                 # below 2**32, so that 2**32 of them add up exactly
        out.append(np.concatenate([np.zeros(1, dtype=np.uint64), _mod(np.cumsum(term))]))
    return out


def span_codes(arrays: list[np.ndarray], start: np.ndarray, stop: np.ndarray, bases: int = 2) -> np.ndarray:
    """The code of each span ``start:stop``; both bases side by side, or the first alone."""
    start, stop = np.asarray(start, dtype=np.int64), np.asarray(stop, dtype=np.int64)
    parts = [_mod(_minus(s[stop], s[start]) * powers.reach(len(s)).down[start])
             for s, powers in zip(arrays[:bases], _POWERS)]
    return parts[0] if bases == 1 else (parts[0] << _SHIFT) | parts[1]


class PrefixHashes:
    """Span equality and longest common extensions of one text; places may be arrays."""

    def __init__(self, text: str | None):
        self.points = code_points(text)
        self.arrays = prefix_arrays(self.points)

    def __len__(self) -> int:
        return len(self.points)

    def codes(self, start, stop) -> np.ndarray:
        return span_codes(self.arrays, start, stop)

    def equal(self, start, stop, other: "PrefixHashes", other_start, other_stop) -> np.ndarray:
        start, stop, other_start, other_stop = np.broadcast_arrays(start, stop, other_start, other_stop)
        return (stop - start == other_stop - other_start) & (
            self.codes(start, stop) == other.codes(other_start, other_stop))

    def extension(self, start, other: "PrefixHashes", other_start, backward: bool = False) -> np.ndarray:
        """Length of the longest common span that begins (``backward``: ends) at both places."""
        a, b = (np.array(x, dtype=np.int64) for x in np.broadcast_arrays(start, other_start))
        low, high = np.zeros_like(a), np.minimum(a, b) if backward else np.minimum(len(self) - a, len(other) - b)
        while (open_ := low < high).any():
            mid = np.where(open_, (low + high + 1) // 2, low)
            same = (self.equal(a - mid, a, other, b - mid, b) if backward
                    else self.equal(a, a + mid, other, b, b + mid))
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low


def shared_ends(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """The pairs with the lengths of the common prefix and of the common suffix of their two texts (in code points)."""
    schema = StructType([*pairs.schema.fields, StructField("common_prefix", LongType()), StructField("common_suffix", LongType())])

    def fn(batches):
        for batch in batches:
            ends = []
            for x, y in zip(batch.column(batch.schema.get_field_index(left)), batch.column(batch.schema.get_field_index(right))):
                a, b = PrefixHashes(x.as_py()), PrefixHashes(y.as_py())
                ends.append((int(a.extension(0, b, 0)), int(a.extension(len(a), b, len(b), backward=True))))
            cols = [pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=schema.names)
    return pairs.mapInArrow(fn, schema)


# ---------------------------------------------------------------- fingerprints

def grid(limit: int) -> np.ndarray:
    """Lengths of the sampled prefixes up to ``limit``: each at most a fifth longer than the one before, or by one."""
    out, x = [], 1
    while x <= limit:
        out.append(x)
        x = max(x + 1, x * 6 // 5)
    return np.array(out, dtype=np.int64)


def _short(codes: np.ndarray) -> np.ndarray:
    return (scramble(codes) >> np.uint64(48)).astype(">u2")


def _fold_spans(least: np.ndarray, owner: np.ndarray, codes: np.ndarray) -> None:
    """Take the mixed span codes into the bins of their texts."""
    mixed = scramble(codes)
    np.minimum.at(least, owner * BINS + (mixed >> np.uint64(58)).astype(np.int64), mixed << np.uint64(6) >> np.uint64(6))


_NONE = np.uint64((1 << 64) - 1)


def _written(n, whole, prefixes, suffixes, least) -> str:
    bins = np.where(least == _NONE, np.uint64(0xFFFF), least % np.uint64(0xFFFF)).astype(">u2")
    return ".".join((f"{n:x}", f"{int(whole):016x}", prefixes.tobytes().hex(), suffixes.tobytes().hex(), bins.tobytes().hex()))


def _many(points: list[np.ndarray]) -> list[str]:
    """Fingerprints of texts that fit one prefix array together."""
    sizes = np.array([len(p) for p in points], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    arrays = prefix_arrays(np.concatenate(points) if len(points) else np.empty(0, dtype=np.uint64))
    whole = span_codes(arrays, begin, begin + sizes)
    lengths = grid(int(sizes.max(initial=0)))
    n_grid = np.searchsorted(lengths, sizes, "right")
    owner = np.repeat(np.arange(len(points)), n_grid)
    first = np.cumsum(n_grid) - n_grid
    length = lengths[np.arange(len(owner)) - first[owner]]
    prefixes = _short(span_codes(arrays, begin[owner], begin[owner] + length))
    end = (begin + sizes)[owner]
    suffixes = _short(span_codes(arrays, end - length, end))
    n_spans = np.where(sizes > 0, np.maximum(sizes - SPAN + 1, 1), 0)
    span_owner = np.repeat(np.arange(len(points)), n_spans)
    start = np.arange(len(span_owner)) - (np.cumsum(n_spans) - n_spans)[span_owner] + begin[span_owner]
    least = np.full(len(points) * BINS, _NONE, dtype=np.uint64)
    _fold_spans(least, span_owner, span_codes(arrays, start, np.minimum(start + SPAN, (begin + sizes)[span_owner]), 1))
    least = least.reshape(-1, BINS)
    return [_written(int(sizes[k]), whole[k], prefixes[a:a + m], suffixes[a:a + m], least[k])
            for k, (a, m) in enumerate(zip(first.tolist(), n_grid.tolist()))]


def _long(points: np.ndarray, segment: int) -> str:
    """Fingerprint of one text, its prefix array held a segment at a time."""
    n = len(points)
    lengths = grid(n)
    wanted = np.unique(np.concatenate([[0, n], lengths, n - lengths]))
    sums: dict[int, tuple[int, int]] = {0: (0, 0)}
    carry, least = [0, 0], np.full(BINS, _NONE, dtype=np.uint64)
    for at in range(0, n, segment):
        part = points[at:at + segment + SPAN - 1]
        size = min(segment, n - at)
        arrays = prefix_arrays(part)
        start = np.arange(min(size, len(part) - SPAN + 1) if n >= SPAN else 1 - bool(at))
        _fold_spans(least, np.zeros(len(start), dtype=np.int64),
                    span_codes(arrays, start, np.minimum(start + SPAN, len(part)) if n >= SPAN else [n] * len(start), 1))
        scale = [pow(b, at, MODULUS) for b in BASES]
        for x in wanted[(wanted > at) & (wanted <= at + size)].tolist():
            sums[x] = tuple((c + s * int(a[x - at])) % MODULUS for c, s, a in zip(carry, scale, arrays))
        carry = [(c + s * int(a[size])) % MODULUS for c, s, a in zip(carry, scale, arrays)]

    def code(i: int, j: int) -> int:
        a, b = ((y - x) * pow(base, -i, MODULUS) % MODULUS for x, y, base in zip(sums[i], sums[j], BASES))
        return a << 31 | b
    prefixes = np.array([code(0, x) for x in lengths.tolist()], dtype=np.uint64)
    suffixes = np.array([code(n - x, n) for x in lengths.tolist()], dtype=np.uint64)
    return _written(n, code(0, n), _short(prefixes), _short(suffixes), least)


def fingerprints(texts: list, segment: int = SEGMENT) -> list[str]:
    """The fingerprint of each text (null: empty)."""
    out: list = [None] * len(texts)
    held, size = [], 0

    def flush():
        for k, f in zip([k for k, _ in held], _many([p for _, p in held])):
            out[k] = f
        held.clear()
    for k, t in enumerate(texts):
        points = code_points(t)
        if len(points) > segment:
            out[k] = _long(points, segment)
            continue
        if size + len(points) > segment:
            flush()
            size = 0
        held.append((k, points))
        size += len(points)
    flush()
    return out


def _common(a: bytes, b: bytes) -> int:
    """How many of the leading grid codes are equal: equal prefixes nest, so a binary search finds the last."""
    low, high = 0, min(len(a), len(b)) // 2
    while low < high:
        mid = (low + high + 1) // 2
        if a[:2 * mid] == b[:2 * mid]:
            low = mid
        else:
            high = mid - 1
    return low


def likeness(first: str, second: str) -> float:
    """Between 0 and 1, from two fingerprints alone; 1 for equal ones."""
    if first == second:
        return 1.0
    (n, _, *a), (m, _, *b) = first.split("."), second.split(".")
    n, m = int(n, 16), int(m, 16)
    if not n or not m:
        return 0.0
    lengths = grid(min(n, m))
    ends = 0
    for x, y in zip(a[:2], b[:2]):
        k = _common(bytes.fromhex(x), bytes.fromhex(y))
        ends += int(lengths[k - 1]) if k else 0
    x, y = (np.frombuffer(bytes.fromhex(z[2]), dtype=">u2") for z in (a, b))
    held = (x != 0xFFFF) | (y != 0xFFFF)
    spans = float((held & (x == y)).sum() / max(1, held.sum()))
    return max(min(ends, n, m) / max(n, m), spans)


# ---------------------------------------------------------------- over a table

def _order(id_col: str, text_col: str) -> list:
    """Ascending sort keys of the descending id order: nulls last, then by text hash."""
    return [F.col(id_col).isNull().cast("long").alias("_null"),
            F.coalesce(F.bitwise_not(F.col(id_col).cast("long")), F.lit(0)).alias("_back"),
            F.xxhash64(F.col(text_col)).alias("_hash")]


_KEY = ["_null", "_back", "_hash"]


def _range_firsts(keys: DataFrame) -> np.ndarray:
    """The first key of each range of about equal numbers of documents, in order: one row a range."""
    dealt = keys.repartitionByRange(n_shuffle(keys.sparkSession), *_KEY)
    rows = dealt.groupBy(F.spark_partition_id().alias("_p")).agg(F.min(F.struct(*_KEY)).alias("f")).select("f.*").collect()
    return np.array(sorted(tuple(r) for r in rows), dtype=np.int64).reshape(-1, 3)


def _targets(firsts: np.ndarray):
    """Range of each key; the first key of a range goes, after its own, to the range before as well."""
    @F.pandas_udf("array<int>")
    def fn(null: pd.Series, back: pd.Series, hashed: pd.Series) -> pd.Series:
        keys = [s.to_numpy(dtype=np.int64) for s in (null, back, hashed)]
        low, high = np.zeros(len(null), dtype=np.int64), np.full(len(null), len(firsts) - 1)
        while (open_ := low < high).any():          # the last range whose first key is not above the row's key
            mid = (low + high + 1) // 2
            above = np.zeros(len(null), dtype=bool)
            tied = np.ones(len(null), dtype=bool)
            for k, key in enumerate(keys):
                above |= tied & (firsts[mid, k] > key)
                tied &= firsts[mid, k] == key
            low, high = np.where(open_ & ~above, mid, low), np.where(open_ & above, mid - 1, high)
        leads = np.all([firsts[low, k] == key for k, key in enumerate(keys)], axis=0)
        return pd.Series([[r, (r - 1) % len(firsts)] if f else [r] for r, f in zip(low.tolist(), leads.tolist())])
    return fn


def _edited(text: str, after: str) -> str:
    cut = len(text) // 3
    return text[:len(text) - cut] + after[:cut]


def _chain_fn(segment: int, schema: StructType):
    """Documents of a range in order; each is finished when its successor is seen."""
    names = schema.names

    def finish(ids, texts, first_mark, id_type):
        marks = [first_mark] if first_mark else []
        marks += fingerprints(texts[len(marks):], segment)
        edited = [_edited(t, after) for t, after in zip(texts, texts[1:])]
        edited_marks = fingerprints(edited, segment)
        batch = pa.RecordBatch.from_arrays([
            pa.array(ids[:-1], id_type), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            pa.array(marks[:-1]), pa.array(edited_marks),
            pa.array([likeness(a, b) for a, b in zip(marks, edited_marks)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(marks, marks[1:])], pa.float64())], names=names)
        return batch, marks[-1]

    def fn(batches):
        ids, texts, mark, held, here, closed = [], [], None, 0, None, False
        for batch in batches:
            for i in range(batch.num_rows):
                which, extra = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                if which != here:               # the range before has ended with the successor of its last document
                    if len(texts) > 1:
                        yield finish(ids, texts, mark, batch.schema.field(0).type)[0]
                    ids, texts, mark, held, here, closed = [], [], None, 0, which, False
                if closed:                      # equal rows of the next range's first key: one successor is enough
                    continue
                closed = bool(extra)
                ids.append(batch.column(0)[i].as_py())
                texts.append(batch.column(3)[i].as_py() or "")
                held += len(texts[-1])
                if len(texts) > 1 and (held > segment or len(texts) > 4096):
                    done, mark = finish(ids, texts, mark, batch.schema.field(0).type)
                    yield done
                    ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])
        if len(texts) > 1:
            yield finish(ids, texts, mark, batch.schema.field(0).type)[0]
    return fn


def chained_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         segment: int = SEGMENT) -> DataFrame:
    """Fingerprint of every text, of the text with its last third edited from its successor, and their likeness."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *_order(id_col, text_col))
    schema = StructType([
        rows.schema["doc_id"], StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
        StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
        StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])
    firsts = _range_firsts(rows.select(*_KEY))
    if not len(firsts):
        return docs.sparkSession.createDataFrame([], schema)
    dealt = rows.withColumn("_to", _targets(firsts)(*_KEY))
    dealt = dealt.select("doc_id", "text", *_KEY, F.posexplode("_to").alias("_extra", "_range"))
    ordered = (dealt.repartitionById(len(firsts), "_range").sortWithinPartitions("_range", "_extra", *_KEY)
               .select("doc_id", "_range", "_extra", "text"))
    return ordered.mapInArrow(_chain_fn(segment, schema), schema)


def op13_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return chained_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op13_prefix_fingerprints": op13_prefix_fingerprints}
SQL: dict = {}
