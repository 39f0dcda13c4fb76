"""Cross-tokenizer alignment by lockstep merging (operator 11).

Two tokenizers cut the same bytes differently.  ``merge`` walks both cuts of a
whole batch of documents at once: one NumPy state vector holds, for every lane,
the current A token and the current B token; a step compares the ends of all
lanes' tokens, emits one link a lane, emits a cut where both end, advances the
side that ends first (both at a cut) and compacts the vector when lanes have
finished.  A lane is a document, or a stretch of a long one between two places
where both tokenizers end, so that a step stays wide and the number of steps
does not follow the longest document.

Over the corpus: the first stage tokenizes, merges and writes, for each
document, its figures and its distinct links with their number.  The counts of
the id pairs are summed in tasks before they are shuffled.  The second stage
looks up the counts: those of the ``FREQUENT`` most frequent pairs (a table of
fixed size) in every task, all others by a join on the pair, none of which is
hot, as it has at most a ``FREQUENT``-th part of all links.  The highest count
of each A id is one row an id, so bounded by the vocabulary.

Defined cases: null or empty texts, and texts that either tokenizer does not
give back byte for byte, have no tokens: zeros and an empty string; special
strings in texts are plain text; repeated and null ids stay rows of their own,
each a document; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import saved, table
from .tokens import PieceMemo, WordMemo

#: A tokens of a lane, about; longer documents are walked in several lanes.
LANE = 128
#: Bytes of text that are merged together, about.
BATCH_BYTES = 1 << 20
#: Pairs whose counts every task holds; the counts of all others are joined.
FREQUENT = 1 << 18
#: Distinct pairs that a task gathers before it hands their counts on.
GATHERED = 1 << 21
#: Stretches that each memo of a worker holds.
MEMO = 300_000


# ---------------------------------------------------------------- tokens and their bytes

def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenPair:
    """Ids and token bytes of both tokenizers; A reads a blank and the text, B adds the blank itself."""

    def __init__(self, a_path: str, b_path: str):
        from tokenizers import Tokenizer

        self._a = WordMemo(a_path, limit=MEMO, plain_specials=True)
        self._b = PieceMemo(b_path, limit=MEMO)
        to_byte = _byte_level()
        vocabulary = Tokenizer.from_file(a_path).get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in entry) if all(c in to_byte for c in entry) else entry.encode()
        self.b_bytes = self._b.token_bytes()
        self.b_ids = len(self.b_bytes)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self._flat = [(np.frombuffer(b"".join(t), dtype=np.uint8), np.cumsum(n) - n)
                      for t, n in ((self.a_bytes, self.a_sizes), (self.b_bytes, self.b_sizes))]

    def tokens(self, texts: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both id lists of each text, empty where either does not give the bytes of a blank and the text."""
        a = [np.frombuffer(self._a.ids_bytes(t, led=True), dtype="<u4") if t else _NO_IDS for t in texts]
        b = [np.frombuffer(self._b.ids_bytes(t), dtype="<u4") if t else _NO_IDS for t in texts]
        want = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        bad = self._differs(a, want, 0) | self._differs(b, want, 1)
        for k in np.flatnonzero(bad).tolist():
            a[k] = b[k] = _NO_IDS
        return a, b

    def _differs(self, ids: list[np.ndarray], want: list[bytes], side: int) -> np.ndarray:
        """Marks the texts whose ids do not join to the wanted bytes."""
        sizes = (self.a_sizes, self.b_sizes)[side]
        flat, begin = self._flat[side]
        joined = np.array([int(sizes[i].sum()) for i in ids], dtype=np.int64)
        bad = joined != np.array([len(w) for w in want], dtype=np.int64)
        fine = np.flatnonzero(~bad).tolist()
        if fine:
            all_ids = np.concatenate([ids[k] for k in fine])
            n = sizes[all_ids]
            place = np.repeat(begin[all_ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            other = flat[place] != np.frombuffer(b"".join([want[k] for k in fine]), dtype=np.uint8)
            if other.any():
                bad[np.unique(np.repeat(fine, joined[fine])[other])] = True
        return bad


_NO_IDS = np.empty(0, dtype="<u4")
_PAIRS: dict = {}


def _pair(a_path: str, b_path: str) -> TokenPair:
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = TokenPair(a_path, b_path)
    return _PAIRS[a_path, b_path]


# ---------------------------------------------------------------- the lockstep merge

def _lane_ends(end_a: np.ndarray, end_b: np.ndarray, last_a: np.ndarray, lane: int) -> np.ndarray:
    """Places of the last A token of each lane: of every document, and of about every ``lane`` tokens where B ends too."""
    first = np.concatenate([[0], last_a[:-1] + 1])
    inner = (last_a - first) // lane
    at = np.repeat(first, inner) + (np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner) + 1) * lane
    ends = [last_a]
    while len(at):
        both = end_b[np.searchsorted(end_b, end_a[at])] == end_a[at]
        ends.append(at[both])
        at = at[~both] + 1            # a document's last token ends for both
    return np.unique(np.concatenate(ends))


def merge(end_a: np.ndarray, end_b: np.ndarray, last_a: np.ndarray, lane: int = LANE):
    """Links and cuts of a batch: (A places, B places) of every overlapping pair, and of every pair that ends together.

    ``end_a`` and ``end_b`` are the ends of all tokens in the bytes of the
    whole batch, ascending; ``last_a`` the place of each document's last A token.
    """
    if not len(last_a):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    stop = _lane_ends(end_a, end_b, last_a, lane)
    i = np.concatenate([[0], stop[:-1] + 1])
    j = np.concatenate([[0], np.searchsorted(end_b, end_a[stop[:-1]]) + 1])
    link_a, link_b, cut_a, cut_b = [], [], [], []
    while len(i):
        x, y = end_a[i], end_b[j]
        link_a.append(i)
        link_b.append(j)
        both = x == y
        cut_a.append(i[both])
        cut_b.append(j[both])
        done = both & (i == stop)
        i, j = i + (x <= y), j + (y <= x)
        if done.any():
            left = ~done
            i, j, stop = i[left], j[left], stop[left]
    return tuple(np.concatenate(p) for p in (link_a, link_b, cut_a, cut_b))


def _decimal(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of every number below ``most``, one byte a digit, and how many there are."""
    texts = [str(i).encode() for i in range(most)]
    width = len(texts[-1]) if texts else 1
    table = np.zeros((most, width + 1), dtype=np.uint8)
    table[:, :width] = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), dtype=np.uint8).reshape(most, width)
    return table, np.array([len(t) for t in texts], dtype=np.int64)


class Aligner:
    """Aligns batches of texts: figures of each document and its distinct links."""

    def __init__(self, pair: TokenPair):
        self.pair = pair
        self.digits, self.widths = _decimal(max(len(pair.a_bytes), len(pair.b_bytes)))

    def align(self, texts: list) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, codes, numbers) of each text.

        ``groups`` is the written grouping as bytes; ``codes`` the distinct
        linked pairs ``a * b_ids + b``, ascending, and ``numbers`` how many
        links each has.
        """
        tokens = self.pair.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in side], dtype=np.int64) for side in tokens)
        ids_a, ids_b = (np.concatenate([_NO_IDS, *side]).astype(np.int64) for side in tokens)
        end_a, end_b = np.cumsum(self.pair.a_sizes[ids_a]), np.cumsum(self.pair.b_sizes[ids_b])
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        full = n_a > 0
        link_a, link_b, cut_a, cut_b = merge(end_a, end_b, upto_a[full] - 1)
        doc_of_a = np.repeat(np.arange(len(texts)), n_a)
        n_groups = np.bincount(doc_of_a[cut_a], minlength=len(texts))
        n_links = np.bincount(doc_of_a[link_a], minlength=len(texts))
        groups, group_ends = self._written(ids_a, ids_b, np.sort(cut_a), np.sort(cut_b), upto_a + upto_b)
        codes, numbers, of_doc = self._distinct(doc_of_a[link_a], ids_a[link_a], ids_b[link_b])
        begin = np.searchsorted(of_doc, np.arange(len(texts) + 1))
        out, at = [], 0
        for k, stop in enumerate(group_ends.tolist()):
            here = slice(begin[k], begin[k + 1])
            out.append((int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), groups[at:max(at, stop - 1)],
                        codes[here], numbers[here]))
            at = stop
        return out

    def _distinct(self, doc, a, b):
        code = a * self.pair.b_ids + b
        key = np.sort((doc << 40) | code)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
        numbers = np.diff(np.append(first, len(key)))
        key = key[first]
        return key & ((1 << 40) - 1), numbers, key >> 40

    def _written(self, ids_a, ids_b, cut_a, cut_b, upto):
        """Bytes of ``a1,a2|b1;`` of all groups, one after another, and where the text of each document ends."""
        is_cut_a, is_cut_b = (np.zeros(len(x), dtype=bool) for x in (ids_a, ids_b))
        is_cut_a[cut_a], is_cut_b[cut_b] = True, True
        group_a, group_b = (np.cumsum(c) - c for c in (is_cut_a, is_cut_b))
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], cut_b + 1])[group_a]        # the B tokens of the groups before
        place_b = np.arange(len(ids_b)) + (cut_a + 1)[group_b] if len(ids_b) else np.empty(0, dtype=np.int64)
        ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        mark = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark[place_a[is_cut_a]], mark[place_b[is_cut_b]] = ord("|"), ord(";")
        rows, width = self.digits[ids], self.widths[ids]
        rows[np.arange(len(ids)), width] = mark
        keep = np.arange(rows.shape[1])[None, :] <= width[:, None]
        ends = np.concatenate([[0], np.cumsum(width + 1)])[upto]
        return rows[keep].tobytes(), ends


# ---------------------------------------------------------------- over a table

def _batched(texts, limit: int):
    """Runs of consecutive places whose texts hold about ``limit`` characters together."""
    run, size = [], 0
    for i in range(len(texts)):
        t = texts[i].as_py()
        run.append(t)
        size += len(t or "")
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _align_fn(a_path: str, b_path: str, batch_bytes: int, names: list[str]):
    def fn(batches):
        aligner = Aligner(_pair(a_path, b_path))
        for batch in batches:
            at = 0
            for texts in _batched(batch.column(1), batch_bytes):
                rows = aligner.align(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(rows)),
                    *[pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
                    pa.array([hashlib.sha256(r[4]).hexdigest() if r[0] else "" for r in rows]),
                    pa.array([r[5].astype("<u4" if r[5].max(initial=0) < 1 << 32 else "<u8").tobytes() for r in rows], pa.binary()),
                    pa.array([r[6].astype("<u1" if r[6].max(initial=0) < 256 else "<u4").tobytes() for r in rows], pa.binary()),
                    pa.array([len(r[5]) for r in rows], pa.int64())], names=names)
                at += len(rows)
    return fn


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, numbers and place in the batch of all links of a batch of (…, codes, numbers, n_codes)."""
    codes, numbers = [], []
    n = batch.column("n_codes").to_numpy()
    for c, m, k in zip(batch.column("codes"), batch.column("numbers"), n.tolist()):
        if k:
            c, m = c.as_py(), m.as_py()
            codes.append(np.frombuffer(c, dtype=f"<u{len(c) // k}").astype(np.int64))
            numbers.append(np.frombuffer(m, dtype=f"<u{len(m) // k}").astype(np.int64))
    empty = np.empty(0, dtype=np.int64)
    return (np.concatenate(codes) if codes else empty, np.concatenate(numbers) if numbers else empty,
            np.repeat(np.arange(len(n)), n))


def _counted(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, dtype=np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _count_fn(gathered: int):
    """How many documents of the task hold each pair; handed on when many pairs have been gathered."""
    def batch_of(codes, n):
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    def fn(batches):
        codes = n = np.empty(0, dtype=np.int64)
        for batch in batches:
            own, counts = np.unique(_links(batch)[0], return_counts=True)
            codes, n = _counted(np.concatenate([codes, own]), np.concatenate([n, counts.astype(np.int64)]))
            if len(codes) > gathered:
                yield batch_of(codes, n)
                codes = n = np.empty(0, dtype=np.int64)
        if len(codes):
            yield batch_of(codes, n)
    return fn


def _lookup(table, codes: np.ndarray):
    """Place of each code in the frequent table, and whether it is there."""
    known = table[0]
    at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
    return at, (known[at] == codes) if len(known) else np.zeros(len(codes), dtype=bool)


def _frequent_fn(frequent):
    def fn(batches):
        table = frequent.value
        for batch in batches:
            codes, numbers, place = _links(batch)
            at, there = _lookup(table, codes)
            place, number, at = place[there], numbers[there], at[there]
            best = np.bincount(place, weights=number * table[2][at], minlength=batch.num_rows).astype(np.int64)
            total = np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(total, place, number * table[1][at])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(best), pa.array(total)],
                                             names=["row", "n_best", "count_sum"])
    return fn


def _rest_fn(frequent):
    def fn(batches):
        table = frequent.value
        for batch in batches:
            codes, numbers, place = _links(batch)
            rest = ~_lookup(table, codes)[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(place[rest])), pa.array(codes[rest]), pa.array(numbers[rest])],
                names=["row", "code", "number"])
    return fn


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                      batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Figures of every document and its distinct links (codes ``a * b_ids + b``), written once and read back."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"], *[StructField(c, LongType()) for c in _FIGURES],
                         StructField("groups_sha256", StringType()), StructField("codes", BinaryType()),
                         StructField("numbers", BinaryType()), StructField("n_codes", LongType())])
    out = rows.mapInArrow(_align_fn(a_path, b_path, batch_bytes, schema.names), schema)
    return saved(out.withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_counts(aligned: DataFrame, b_ids: int, gathered: int = GATHERED) -> DataFrame:
    """(code, n, best): documents that hold each linked pair, and whether that is the highest count of its A id."""
    parts = aligned.select("codes", "numbers", "n_codes").mapInArrow(_count_fn(gathered), "code long, n long")
    counts = saved(parts.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.floor(F.col("code") / b_ids)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))
    # one row an A id: bounded by the vocabulary
    return (counts.withColumn("a", a).join(F.broadcast(highest), "a")
            .select("code", "n", (F.col("n") == F.col("highest")).alias("best")))


def corpus_links(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The figures of every document with n_best and count_sum, from the corpus-wide counts."""
    spark = aligned.sparkSession
    top = counts.orderBy(F.desc("n"), "code").limit(frequent).toArrow().sort_by("code")
    held = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy().astype(t) for c, t in
                                              (("code", np.int64), ("n", np.int64), ("best", np.int64))))
    links = aligned.select("row", "codes", "numbers", "n_codes")
    near = links.mapInArrow(_frequent_fn(held), "row long, n_best long, count_sum long")
    rest = links.mapInArrow(_rest_fn(held), "row long, code long, number long")
    far = rest.join(counts, "code").select(
        "row", (F.col("number") * F.col("best").cast("long")).alias("n_best"), (F.col("number") * F.col("n")).alias("count_sum"))
    sums = near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.select("row", "doc_id", *_FIGURES, "groups_sha256").join(sums, "row").drop("row")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align the tokens of every document between byte_bpe_50k.json and piece_bpe_32k.model."""
    import public_tokenizers

    a_path, b_path = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = aligned_documents(table(spark, sf_dir, "documents"), a_path, b_path)
    b_ids = len(PieceMemo(b_path).pieces)
    linked = corpus_links(aligned, pair_counts(aligned, b_ids))
    return linked.select("doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256")


QUERIES = {"op11_token_alignment": op11_token_alignment}
SQL: dict = {}
