"""Substring de-duplication with suffix automata (operator 7).

A word is removed when a window of ``window`` words that covers it also starts
earlier (smaller document id, or the same document further left).

The reference is the corpus itself, so sending the automata of all its shards
to every document would grow with the square of the input.  Shards are cut so
that a document meets only those that can match it:

1. each window is assigned to its anchor, the smallest hash among its
   ``ANCHOR``-word stretches; equal windows have equal anchors.  Neighbouring
   windows with one anchor form a passage.
2. anchors that occur once match nothing and end there.  Passages that equal an
   earlier passage of their anchor are removed whole.
3. what remains, first passages of anchors that have several different ones, is
   dealt to shards by anchor.  A shard's task takes its passages in document
   order, streams each through the suffix automaton of the earlier ones, and
   removes the spans whose matching statistics reach ``window``; then it adds
   the passage to the automaton.
4. an anchor with more than ``HOT_PASSAGES`` different passages would make a
   shard without bound; its windows are compared one by one by their hash.

Defined cases: null and empty texts have no words; shorter texts lose nothing;
null ids come last, rows with equal ids are ordered by their place in the
table; an empty table gives an empty result; other columns are ignored.
Windows and anchors are named by 64-bit hashes.  ``docs`` is read from files,
so that its rows get the same numbers in every job.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType)

from .common import BATCH_ROWS, TokenCodes, byte_words, chunks, saved, scramble, table, window_codes

WINDOW = 20
ANCHOR = 6
HOT_PASSAGES = 2000
SHARD_PASSAGES = 4000
#: Spans up to which the counted table of them is sent to the workers instead of joined by a shuffle.
SENT_SPANS = 1_000_000


# ---------------------------------------------------------------- passages

def _passages(codes: np.ndarray, window: int, anchor: int):
    """anchor code, passage code, first and last window start of each passage of a text."""
    n = len(codes) - window + 1
    small = window_codes(codes, anchor)
    near = np.lib.stride_tricks.sliding_window_view(small, window - anchor + 1)
    at = near.argmin(axis=1) + np.arange(n)
    cut = np.flatnonzero(at[1:] != at[:-1]) + 1
    lo = np.concatenate([[0], cut])
    hi = np.concatenate([cut - 1, [n - 1]])
    whole = window_codes(codes, window)
    code = scramble(whole[lo] * np.uint64(31) + whole[hi] + (hi - lo).astype(np.uint64))
    return small[at[lo]], code, lo, hi


def _anchor_fn(window: int, anchor: int):
    def cut(batches):
        codes = TokenCodes()
        for batch in batches:
            marks, ids, texts = batch.column(0), batch.column(1), batch.column(2)
            for rows in chunks(range(batch.num_rows), 128):
                parts, take = [], []
                for i in rows:
                    words = byte_words(texts[i].as_py())
                    if len(words) >= window:
                        parts.append(_passages(codes.of(words), window, anchor))
                        take.append(np.full(len(parts[-1][0]), i))
                if parts:
                    a, p, lo, hi = (np.concatenate(x) for x in zip(*parts))
                    where = pa.array(np.concatenate(take))
                    yield pa.RecordBatch.from_arrays(
                        [marks.take(where), ids.take(where), pa.array(a.view(np.int64)), pa.array(p.view(np.int64)),
                         pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                        names=["row", "doc_id", "anchor", "passage", "lo", "hi"])
    return cut


def _codes_fn(window: int):
    """Word codes of the passages that are asked for; windows of hot anchors one by one."""
    def cut(batches):
        codes = TokenCodes()
        for batch in batches:
            for k in range(batch.num_rows):
                row, doc, text, asked = (batch.column(c)[k].as_py() for c in range(4))
                coded = codes.of(byte_words(text))
                single = None
                keys, hot, places, values = [], [], [], []
                for x in asked:
                    if x["hot"]:
                        single = window_codes(coded, window) if single is None else single
                        for s in range(x["lo"], x["hi"] + 1):
                            keys.append(int(single[s].view(np.int64)))
                            hot.append(True)
                            places.append(s)
                            values.append(None)
                    else:
                        keys.append(x["anchor"])
                        hot.append(False)
                        places.append(x["lo"])
                        values.append(coded[x["lo"]:x["hi"] + window].view(np.int64))
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(hot, pa.bool_()), pa.array([row] * n, pa.int64()),
                     batch.column(1).take(pa.array([k] * n, pa.int64())), pa.array(places, pa.int32()),
                     pa.array(values, pa.list_(pa.int64()))],
                    names=["key", "hot", "row", "doc_id", "lo", "codes"])
    return cut


# ---------------------------------------------------------------- suffix automaton

class SuffixAutomaton:
    """Suffix automaton of several sequences, grown one sequence at a time."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, q: int, token) -> int:
        """A copy of ``q`` for the shorter contexts that reach it from ``p``."""
        clone = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, tokens) -> None:
        last = 0
        for token in tokens:
            q = self.next[last].get(token)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, q, token)
                continue
            new = self._state(self.size[last] + 1, 0, {})
            p = last
            while p >= 0 and token not in self.next[p]:
                self.next[p][token] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][token]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, token)
            last = new

    def matching_statistics(self, tokens) -> list[int]:
        """For each place the length of the longest stretch ending there that some sequence holds."""
        out, state, length = [], 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            else:
                length = 0
            out.append(length)
        return out


def _stream_fn(window: int):
    def stream(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_null=pdf["doc_id"].isna()).sort_values(["key", "_null", "doc_id", "row", "lo"])
        rows, los, his = [], [], []
        automaton, key = SuffixAutomaton(), None
        for k, row, lo, codes in zip(pdf["key"], pdf["row"], pdf["lo"], pdf["codes"]):
            if k != key:                      # equal windows have equal anchors: other anchors cannot match
                automaton, key = SuffixAutomaton(), k
            codes = codes.tolist()
            found = [i for i, m in enumerate(automaton.matching_statistics(codes)) if m >= window]
            for i in found:
                rows.append(row)
                los.append(lo + i - window + 1)
                his.append(lo + i - window + 1)
            automaton.add(codes)
        return pd.DataFrame({"row": rows, "lo": los, "hi": his}).astype({"row": "int64", "lo": "int32", "hi": "int32"})
    return stream


# ---------------------------------------------------------------- spans

def _merge_fn(window: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """Spans of words, joined where they touch."""
        pdf = pdf.sort_values(["row", "lo"], ignore_index=True)
        rows, starts, ends = [], [], []
        for row, lo, hi in zip(pdf["row"].tolist(), pdf["lo"].tolist(), pdf["hi"].tolist()):
            if rows and rows[-1] == row and lo <= ends[-1]:
                ends[-1] = max(ends[-1], hi + window)
            else:
                rows.append(row)
                starts.append(lo)
                ends.append(hi + window)
        return pd.DataFrame({"row": rows, "start": starts, "end": ends}).astype(
            {"row": "int64", "start": "int32", "end": "int32"})
    return merge


def _keep_fn():
    def keep(batches):
        for batch in batches:
            ids, texts, spans = batch.column(0), batch.column(1), batch.column(2)
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                total, removed, digest, kept_text = [], [], [], []
                for i in rows:
                    words = byte_words(texts[i].as_py())
                    kept, at = [], 0
                    for s in sorted((x["start"], x["end"]) for x in spans[i].as_py() or []):
                        kept += words[at:s[0]]
                        at = s[1]
                    kept += words[at:]
                    joined = b" ".join(kept)
                    total.append(len(words))
                    removed.append(len(words) - len(kept))
                    digest.append(hashlib.sha256(joined).hexdigest())
                    kept_text.append(joined.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(rows[0], len(rows)), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(digest), pa.array(kept_text)],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return keep


def _place(lo: str = "lo"):
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("row").alias("r"),
                    F.col(lo).alias("lo"))


def _tasks(df: DataFrame, per_task: int) -> int:
    return max(1, -(-df.count() // per_task))


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   hot_passages: int = HOT_PASSAGES) -> DataFrame:
    """``row, start, end``: maximal spans of words of ``docs`` (row, doc_id, text) that windows repeat."""
    id_type = docs.schema["doc_id"].dataType
    schema = StructType([StructField("row", LongType()), StructField("doc_id", id_type),
                         StructField("anchor", LongType()), StructField("passage", LongType()),
                         StructField("lo", IntegerType()), StructField("hi", IntegerType())])
    every = saved(docs.select("row", "doc_id", "text").mapInArrow(_anchor_fn(window, anchor), schema), "anchors")
    often = saved(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "often")
    again = saved(every.join(often, "anchor", "left_semi"), "again")

    first = saved(again.groupBy("anchor", "passage").agg(F.min(F.struct(_place().alias("p"), "hi")).alias("f"))
                  .select("anchor", "passage", "f.p", F.col("f.hi").alias("hi")), "first")
    copies = (again.join(first.select("anchor", "passage", F.col("p.r").alias("fr"), F.col("p.lo").alias("fl")),
                         ["anchor", "passage"])
              .where((F.col("row") != F.col("fr")) | (F.col("lo") != F.col("fl"))).select("row", "lo", "hi"))

    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    asked = saved(first.join(several, "anchor").select(
        F.col("p.r").alias("row"), "anchor", F.col("p.lo").alias("lo"), "hi",
        (F.col("n") > hot_passages).alias("hot")), "asked")
    n_asked = asked.count()
    by_row = asked.groupBy("row").agg(F.collect_list(F.struct("anchor", "lo", "hi", "hot")).alias("asked"))
    coded_schema = StructType([StructField("key", LongType()), StructField("hot", BooleanType()),
                               StructField("row", LongType()), StructField("doc_id", id_type),
                               StructField("lo", IntegerType()), StructField("codes", ArrayType(LongType()))])
    coded = saved(docs.join(by_row, "row").select("row", "doc_id", "text", "asked")
                  .mapInArrow(_codes_fn(window), coded_schema), "coded")
    shards = max(1, -(-n_asked // SHARD_PASSAGES))
    streamed = (coded.where(~F.col("hot")).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
                .groupBy("shard").applyInPandas(_stream_fn(window), "row long, lo int, hi int"))
    hot = coded.where("hot")
    hot_first = hot.groupBy("key").agg(F.min(_place()).alias("p"))
    hot_later = (hot.join(hot_first, "key").where((F.col("row") != F.col("p.r")) | (F.col("lo") != F.col("p.lo")))
                 .select("row", "lo", F.col("lo").alias("hi")))
    spans = saved(copies.unionByName(streamed).unionByName(hot_later), "spans")
    return (spans.withColumn("task", F.pmod(F.xxhash64("row"), F.lit(_tasks(spans, 100_000))))
            .groupBy("task").applyInPandas(_merge_fn(window), "row long, start int, end int"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 anchor: int = ANCHOR, hot_passages: int = HOT_PASSAGES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    spans = saved(repeated_spans(rows, window, anchor, hot_passages), "merged")
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    by_row = F.broadcast(by_row) if spans.count() <= SENT_SPANS else by_row
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("n_words", LongType()),
                         StructField("n_removed", LongType()), StructField("kept_sha256", StringType()),
                         StructField("kept_text", StringType())])
    return rows.join(by_row, "row", "left").select("doc_id", "text", "spans").mapInArrow(_keep_fn(), schema)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, and a digest of those kept."""
    return deduplicated(table(spark, sf_dir, "documents")).drop("kept_text")


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
SQL = {"op7_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
  SELECT doc_id, s, array_to_string(list_slice(words, s, s + 19), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w WHERE len(words) >= 20)
), r AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS k FROM g) WHERE k > 1
), c AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM r
), x AS (
  SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
         CASE WHEN gone IS NULL THEN words
              ELSE list_filter(list_transform(range(1, len(words) + 1),
                     lambda i: CASE WHEN list_contains(gone, i) THEN NULL ELSE words[i] END),
                   lambda z: z IS NOT NULL) END, ' ')) AS kept_sha256
FROM w LEFT JOIN x ON w.doc_id = x.doc_id
"""}
