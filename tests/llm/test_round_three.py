"""Operators 11, 12 and 13 against plain Python."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from recspark.llm import alignment, hard_negatives, prefix_hash
from tests.conftest import SF_SMALL
from tests.llm.conftest import CLASHING

P = pytest.importorskip("public_tokenizers")
A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SPECIALS = ["<|endoftext|> and <s> </s>", "▁mark", "é́ \U0001F600 ﬁ", "tab\there", " lead", "trail \n", "\x00"]


# ---------------------------------------------------------------- 11

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def _pieces(libraries, text):
    """(id, begin, end) of both tokenizers in the bytes of a blank and the text; nothing where the bytes differ."""
    from tokenizers.pre_tokenizers import ByteLevel

    a, b = libraries
    if not text:
        return [], []
    want = (" " + text).encode()
    chars = sorted(ByteLevel.alphabet())
    printable = [c for c in chars if ord(c) < 256]
    rest = [c for c in chars if ord(c) >= 256]
    other = [x for x in range(256) if chr(x) not in printable]
    byte = {c: ord(c) for c in printable} | dict(zip(rest, other))

    def spans(ids, parts):
        at, out = 0, []
        for i, p in zip(ids, parts):
            out.append((i, at, at + len(p)))
            at += len(p)
        return out if b"".join(parts) == want else None
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    left = spans(a_ids, [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids])
    right = spans(b_ids, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                          else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids])
    return (left, right) if left is not None and right is not None else ([], [])


def _plain_alignment(libraries, rows):
    docs, held = [], Counter()
    for doc_id, text in rows:
        left, right = _pieces(libraries, text)
        links, j = Counter(), 0
        for x, p, q in left:
            while right[j][2] <= p:
                j += 1
            k = j
            while k < len(right) and right[k][1] < q:
                links[x, right[k][0]] += 1
                k += 1
        cuts, parts = sorted({q for _, _, q in left} & {q for _, _, q in right}), []
        for side in (left, right):
            parts.append([[] for _ in cuts])
            for x, _, q in side:
                parts[-1][bisect.bisect_left(cuts, q)].append(str(x))
        groups = ["|".join(map(",".join, g)) for g in zip(*parts)]
        held.update(links.keys())
        docs.append((doc_id, len(left), len(right), groups, links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [(i, n_a, n_b, len(g), sum(links.values()), sum(n for (x, y), n in links.items() if held[x, y] == best[x]),
             sum(n * held[p] for p, n in links.items()),
             hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "") for i, n_a, n_b, g, links in docs]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _aligned(spark, docs, frequent, batch_bytes=1 << 20):
    rows = alignment.aligned_documents(docs, A_PATH, B_PATH, batch_bytes=batch_bytes)
    counts = alignment.pair_counts(rows, 32_000, gathered=50)
    return sorted((tuple(r[c] for c in COLUMNS) for r in alignment.corpus_links(rows, counts, frequent).collect()), key=repr)


@pytest.mark.parametrize("frequent,batch_bytes", [(1, 1), (40, 3000), (1 << 18, 1 << 20)])
def test_alignment_of_messy_documents(spark, messy, libraries, frequent, batch_bytes):
    _, docs = messy
    extra = spark.createDataFrame([(100 + k, t) for k, t in enumerate(SPECIALS)], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    want = _plain_alignment(libraries, [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(x[1] == 0 for x in want) >= 3 and any(x[5] < x[4] for x in want)
    assert _aligned(spark, docs, frequent, batch_bytes) == sorted(want, key=repr)


def test_alignment_query(spark, libraries):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = alignment.op11_token_alignment(spark, SF_SMALL)
    assert got.columns == COLUMNS
    want = _plain_alignment(libraries, [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("lane", [1, 2, 7, 1000])
def test_merge_of_random_cuts(lane):
    rng = random.Random(lane)
    for _ in range(200):
        end_a, end_b, last = [], [], []
        at = 0
        for _ in range(rng.randint(1, 4)):
            size = rng.randint(1, 40)
            inner = range(1, size)
            end_a += [at + x for x in sorted(rng.sample(inner, rng.randint(0, size - 1)))] + [at + size]
            end_b += [at + x for x in sorted(rng.sample(inner, rng.randint(0, size - 1)))] + [at + size]
            last.append(len(end_a) - 1)
            at += size
        i, j, cut_a, cut_b = alignment.merge(np.array(end_a), np.array(end_b), np.array(last), lane)
        begin_a, begin_b = [0, *end_a[:-1]], [0, *end_b[:-1]]
        want = {(x, y) for x in range(len(end_a)) for y in range(len(end_b))
                if begin_a[x] < end_b[y] and begin_b[y] < end_a[x]}
        assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
        assert sorted(end_a[x] for x in cut_a) == sorted(set(end_a) & set(end_b)) == sorted(end_b[y] for y in cut_b)


# ---------------------------------------------------------------- 12

@pytest.mark.parametrize("top", [1, 3, 200, 1 << 14, 1 << 20, 1 << 25, 10 ** 30])
def test_packed_products(top):
    rng = random.Random(top)
    for dims in (1, 5, 64):
        a, r = ([[rng.randint(-top, top) for _ in range(dims)] for _ in range(n)] for n in (6, 17))
        want = [[sum(x * y for x, y in zip(u, v)) for v in r] for u in a]
        kind = object if top > 1 << 25 else np.int64
        assert hard_negatives.packed_products(np.array(a, dtype=kind), np.array(r, dtype=kind)).tolist() == want


def _plain_negatives(rows, every=100, positives=5, negatives=5):
    import math

    by_id = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        by_id[i] = min(by_id.get(i, (label, vec)), (label, vec))
    whole = {i: [256 * n // d for n, d in (float(x).as_integer_ratio() for x in vec)] for i, (_, vec) in by_id.items()}

    def score(a, b):
        return max(-(1 << 53), min(1 << 53, sum(x * y for x, y in zip(whole[a], whole[b]))))
    out = []
    for a in by_id:
        if a % every:
            continue
        ranked = sorted(((-score(a, i), i) for i in by_id if i != a))
        for s, p in [x for x in ranked if by_id[x[1]][0] == by_id[a][0]][:positives]:
            window = [(t, i) for t, i in ranked if by_id[i][0] != by_id[a][0] and -80 * s <= -100 * t <= -100 * s]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(window[:negatives])]
    return sorted(out)


def _mined(spark, rows, **params):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, rank string, positives int").repartition(3)
    from pyspark.sql import functions as F

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    usable = hard_negatives.usable(df, "vec_id", moved, "embedding")
    return sorted(map(tuple, hard_negatives.hard_negatives(usable, usable.where(F.col("vec_id") % 100 == 0), **params).collect()))


def test_hard_negatives_of_messy_vectors(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for i in range(900):
        base = [0.3, -0.2, 0.4, 0.1] if i % 3 == 0 else [rng.gauss(0, 0.3) for _ in range(4)]     # a third are copies
        rows.append([i, i % 3 if i % 5 else None, [round(x, 3) for x in base]])
    for k, odd in enumerate([None, [], [None, 1.0], [float("nan"), 0.0], [float("inf"), 1.0], [0.5], [0.1, 0.2, 0.3, 0.4, 0.5],
                             [1e300, 1.0], [-1e9, 0.5, 0.5, 0.5]]):
        rows[100 * k] = [100 * k, k % 3, odd]
        rows[100 * k + 1] = [100 * k + 1, 0, odd]
    rows += [[None, 1, [0.1] * 4], [150, 2, [0.3, 0.3, 0.3, 0.3]], [150, 1, [0.2, 0.3, 0.3, 0.3]], rows[303], rows[700]]
    want = _plain_negatives(rows)
    wide = [(*r, "x" if r[0] else None, r[1]) for r in rows]
    assert len(want) > 20
    assert _mined(spark, wide) == want
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 4)        # many blocks of both sides
    monkeypatch.setattr(hard_negatives, "TILE", 64)
    assert _mined(spark, wide) == want


def test_hard_negatives_without_rows(spark):
    assert _mined(spark, []) == []
    assert _mined(spark, [(100, 1, [0.5, 0.5], None, None), (3, 2, [0.5, 0.5], None, None)]) == []


def test_hard_negatives_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    assert sorted(map(tuple, hard_negatives.op12_hard_negatives(spark, SF_SMALL).collect())) == _plain_negatives(rows)


# ---------------------------------------------------------------- 13

def test_span_equality_and_extensions():
    rng = random.Random(13)
    for _ in range(300):
        a = "".join(rng.choice("ab\0é\U0001F600") for _ in range(rng.randint(0, 40)))
        b = a[:rng.randint(0, 40)] + "".join(rng.choice("ab\0é") for _ in range(rng.randint(0, 12)))
        x, y = prefix_hash.PrefixHashes(a), prefix_hash.PrefixHashes(b)
        i, j, n = rng.randint(0, len(a)), rng.randint(0, len(b)), rng.randint(0, 5)
        assert bool(x.equal(i, min(i + n, len(a)), y, j, min(j + n, len(b)))) == (a[i:i + n] == b[j:j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert x.extension(i, y, j) == k
        k = 0
        while k < min(i, j) and a[i - 1 - k] == b[j - 1 - k]:
            k += 1
        assert x.extension(i, y, j, backward=True) == k


def _plain_code(text, base):
    return sum((ord(c) + 1) * pow(base, k, prefix_hash.MODULUS) for k, c in enumerate(text)) % prefix_hash.MODULUS


def test_fingerprint_fields_and_segments():
    rng = random.Random(14)
    texts = ["", None, "a", "ab" * 30, "x" * 5000] + ["".join(rng.choice("abcd efgh") for _ in range(rng.randint(1, 900))) for _ in range(40)]
    marks = prefix_hash.fingerprints(texts)
    for segment in (1, 25, 333, 4000):
        assert prefix_hash.fingerprints(texts, segment=segment) == marks
    for t, m in zip(texts, marks):
        n, whole, prefixes, suffixes, bins = m.split(".")
        assert int(n, 16) == len(t or "")
        first, second = (_plain_code(t or "", b) for b in prefix_hash.BASES)
        assert int(whole, 16) == first << 31 | second
        assert len(prefixes) == len(suffixes) == 4 * len(prefix_hash.grid(len(t or ""))) and len(bins) == 4 * prefix_hash.BINS


def test_likeness():
    rng = random.Random(15)

    def text(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))
    body = text(3000)
    mark, same, start, end, middle, unlike, empty = prefix_hash.fingerprints(
        [body, str(body), body[:2000] + text(1000), text(1000) + body[1000:], body[:1500] + "xyz" + body[1503:], text(3000), ""])
    assert mark == same and prefix_hash.likeness(mark, same) == prefix_hash.likeness(empty, empty) == 1.0
    assert 0.5 <= prefix_hash.likeness(mark, start) < 0.75 and 0.5 <= prefix_hash.likeness(mark, end) < 0.75
    assert prefix_hash.likeness(mark, middle) > 0.8
    assert prefix_hash.likeness(mark, unlike) < 0.1 and prefix_hash.likeness(mark, empty) == 0.0
    for a in (mark, start, end, unlike, empty):
        for b in (mark, start, end, unlike, empty):
            assert 0.0 <= prefix_hash.likeness(a, b) == prefix_hash.likeness(b, a) <= 1.0


def _plain_chain(rows):
    """Rows of the result without order among equal ids: (doc_id, n_chars, edited hash, marks, likeness)."""
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + u[:cut]
        f, g, h = prefix_hash.fingerprints([t, edited, u])
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g, prefix_hash.likeness(f, g), prefix_hash.likeness(f, h)))
    return sorted(out, key=repr)


def test_chain_of_messy_documents(spark, messy):
    _, docs = messy
    keyed = docs.select("doc_id", "text", *prefix_hash._order("doc_id", "text")).collect()
    rows = [(r.doc_id, r.text or "") for r in sorted(keyed, key=lambda r: (r._null, r._back, r._hash))]
    ids = [i for i, _ in rows]
    assert ids == sorted(ids, key=lambda i: (i is None, -(i or 0)))
    want = _plain_chain(rows)
    for segment in (50, 1 << 18):
        got = prefix_hash.chained_fingerprints(docs, segment=segment)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert set(CLASHING) <= set(docs.columns)


def test_chain_of_one_document(spark):
    docs = spark.createDataFrame([(5, "some text of a few words")], "doc_id long, text string")
    assert [tuple(r) for r in prefix_hash.chained_fingerprints(docs).collect()] == _plain_chain([(5, "some text of a few words")])


def test_chain_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text or "") for r in sorted(docs, key=lambda r: -r.doc_id)]
    got = prefix_hash.op13_prefix_fingerprints(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=repr) == _plain_chain(rows)


def test_shared_ends(spark):
    pairs = spark.createDataFrame([(1, "abcdxyz", "abqxyz"), (2, None, "a"), (3, "same", "same"), (4, "", "")],
                                  "pair long, one string, two string")
    got = {r.pair: (r.common_prefix, r.common_suffix) for r in prefix_hash.shared_ends(pairs, "one", "two").collect()}
    assert got == {1: (2, 3), 2: (0, 0), 3: (4, 4), 4: (0, 0)}
