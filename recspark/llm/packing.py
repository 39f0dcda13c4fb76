"""Best-fit packing with certified bin counts (operator 5).

Texts become token pieces of at most ``capacity`` ids.  Pieces are dealt into
groups of bounded size; every group packs best-fit decreasing and proves a
lower bound on its number of bins with dual-feasible functions.  Groups whose
count exceeds the bound hand over the pieces of their loose bins; those are
dealt anew, packed best-fit decreasing again, and the new packing replaces the
old one where it needs fewer bins.  Rounds end when every group is certified,
a round saves nothing, or ``rounds`` are done.

Defined cases: null or empty text is a document of the end id alone; repeated
or null document ids are packed as separate documents; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import BATCH_ROWS, chunks, saved, table
from .tokens import memo_for

CAPACITY = 4096
END_ID = 1


# ---------------------------------------------------------------- pieces

def _piece_fn(tokenizer: str, capacity: int, end_id: int, keep_ids: bool):
    def cut(batches):
        memo = memo_for(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1)
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                take, piece, start, length, crc, ids = [], [], [], [], [], []
                for i in rows:
                    blob = memo.ids_bytes(texts[i].as_py() or "") + end
                    for k, at in enumerate(range(0, len(blob), 4 * capacity)):
                        part = blob[at:at + 4 * capacity]
                        take.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            ids.append(np.frombuffer(part, dtype="<i4"))
                cols = [docs.take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return cut


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, with the ids themselves on request."""
    fields = [StructField("doc_id", docs.schema[id_col].dataType), StructField("piece", IntegerType()),
              StructField("start", LongType()), StructField("length", LongType()),
              StructField("ids_crc32", LongType())]
    if keep_ids:
        fields.append(StructField("ids", ArrayType(IntegerType(), False)))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _piece_fn(tokenizer, capacity, end_id, keep_ids), StructType(fields))


# ---------------------------------------------------------------- bounds and best fit

def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual-feasible functions in whole numbers.

    Two families and the plain sum: a threshold function (long items count as a
    whole bin, short ones as nothing) and the rounding function
    ``u_k(x) = x if (k+1)x is whole else floor((k+1)x)/k``.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for eps in np.unique(np.concatenate([sizes[sizes <= capacity // 2],
                                         capacity - sizes[sizes > capacity // 2] + 1])):
        value = np.where(sizes > capacity - eps, capacity, np.where(sizes >= eps, sizes, 0))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, k * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]   # by room left
    rooms = 0                                                        # bit r: a bin with room r is open
    count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, count


_PACKED = "item long, length long, bin long, offset long, free long, gap long"


def _pack_fn(capacity: int, tag: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        lengths = pdf["length"].to_numpy(dtype=np.int64)
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        group = int(pdf["group"].iloc[0])
        return pd.DataFrame({
            "item": pdf["item"], "length": lengths,
            "bin": ((tag << 56) | (group << 28)) + bins, "offset": offsets,
            "free": capacity - used[bins], "gap": count - lower_bound(lengths, capacity)})
    return pack


def _packed(items: DataFrame, capacity: int, group_items: int, tag: int) -> DataFrame:
    """Deal items into groups of about ``group_items`` and pack each; groups stay bounded at any input size."""
    groups = max(1, -(-items.count() // group_items))
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(tag)), F.lit(groups)).alias("group"))
    return saved(dealt.groupBy("group").applyInPandas(_pack_fn(capacity, tag), _PACKED), f"packed-{tag}")


def _bins(packed: DataFrame) -> int:
    return packed.where(F.col("offset") == 0).count()


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = 20_000, rounds: int = 4,
         loose: int = 16) -> DataFrame:
    """Bin and offset of each ``(item, length)`` row; lengths between 1 and ``capacity``.

    Returns item, length, bin, offset.  A bin is loose when more than
    ``loose`` ids of it are free; only loose bins of uncertified groups are
    exchanged.
    """
    current = _packed(items, capacity, group_items, 0)
    for tag in range(1, rounds + 1):
        exchanged = current.where((F.col("gap") > 0) & (F.col("free") > loose))
        before = _bins(exchanged)
        if before < 2:
            break
        again = _packed(exchanged, capacity, group_items, tag)
        if _bins(again) >= before:
            break
        kept = current.where((F.col("gap") <= 0) | (F.col("free") <= loose))
        current = kept.unionByName(again)
    return current.select("item", "length", "bin", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document with their place: sequence_id and offset."""
    pieces = saved(token_pieces(docs, tokenizer, capacity, end_id, False, id_col, text_col)
                   .withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.select("item", "length"), capacity)
    return (pieces.join(placed.select("item", F.col("bin").alias("sequence_id"), "offset"), "item")
            .drop("item"))


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, doc_ids, ids (at most ``capacity`` a row)."""
    pieces = saved(token_pieces(docs, tokenizer, capacity, end_id, True)
                   .withColumn("item", F.monotonically_increasing_id()), "pieces-ids")
    placed = pack(pieces.select("item", "length"), capacity)
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (pieces.join(placed.select("item", "bin", "offset"), "item")
            .groupBy(F.col("bin").alias("sequence_id")).agg(inside.alias("_in"))
            .select("sequence_id", F.col("_in.doc_id").alias("doc_ids"), F.flatten("_in.ids").alias("ids")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the documents in sequences of 4096 ids."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of 4096 ids."""
    return packing_stage(spark, table(spark, sf_dir, "documents"), sf_dir)


QUERIES = {"op5_packing": op5_packing}
SQL: dict = {}
