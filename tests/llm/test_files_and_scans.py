"""Operators 1, 2, 5, 6, 9: round trips, certificates and held-out plants."""

import base64
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from recspark.llm import license_scan, packing, secret_scan, token_orc, warc
from recspark.llm.tokens import PieceMemo, WordMemo
from recspark.session import scratch_path
from tests.llm.conftest import sentence

P = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_equals_the_library(name):
    memo = WordMemo(P.path(name), limit=50)
    rng = random.Random(3)
    letters = " \n\t'sabtéΣ́.,1 \x1c　<|>%#*ĳɐあ"
    texts = ["", " ", "a", "a  b", "don't it's, x", "<|endoftext|> a", "a\n\nb", "x\r\ny", "İ ẞ Σας", "日本語 テスト\nabc"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    specials = ["hello <|endoftext|> world", "<|startoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "x\n<|endoftext|>"]
    plain = WordMemo(P.path(name), limit=50, plain_specials=True)
    for encode, own in ((_library(name), memo), (_library(name, True), plain)):
        for t in texts + specials:
            assert own.ids(t).tolist() == encode(t), repr(t)
            assert np.frombuffer(own.ids_bytes(t, led=True), "<u4").tolist() == encode(" " + t), repr(t)


def test_pieces_equal_the_library():
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    memo, library = PieceMemo(path, limit=50), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    letters = " \n\t'sabtéΣ.,1 \x00<|>\u2581ĳﬁ가"
    texts = ["", " ", "\n", "a\n", "a\n\nb", "<s> </s>", "x\u2581y", "a \tb", "line one\nline two"]
    for t in texts + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)]:
        assert np.frombuffer(memo.ids_bytes(t), "<u4").tolist() == library.encode(t), repr(t)


def _library(name, plain=False):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path(name))
    if plain:
        tok.encode_special_tokens = True
    return lambda t: tok.encode(t, add_special_tokens=False).ids


def _encoder(name):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path(name))
    return lambda t, end: np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], dtype="<u4")


def test_token_orc_round_trip(spark, messy):
    _, docs = messy
    path = scratch_path(spark, "orc-test")
    schema = token_orc.write_token_orc(docs, path, P.path("byte_bpe_50k.json"))
    files = token_orc.read_token_orc(spark, path, schema)
    got = sorted(token_orc.token_digests(files).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    encode, want = _encoder("byte_bpe_50k.json"), {}
    for r in docs.collect():
        own = encode(r.text, 0)
        want.setdefault(r.doc_id, []).append((len(own), zlib.crc32(own.tobytes())))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(want.values())
    one = token_orc.documents_by_id(spark, path, schema, [11])
    assert [len(r.tokens) for r in one.collect()] == [r.n_tokens for r in got if r.doc_id == 11]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "doc_id" in plan.split("PushedFilters")[1]


def test_packing_is_whole_and_certified(spark, messy):
    _, docs = messy
    got = packing.pack_documents(docs, P.path("word_bpe_49k.json"), capacity=64).collect()
    encode, want = _encoder("word_bpe_49k.json"), []
    for r in docs.collect():
        own = encode(r.text, 1)
        want += [(r.doc_id, k, at, len(own[at:at + 64]), zlib.crc32(own[at:at + 64].tobytes()))
                 for k, at in enumerate(range(0, len(own), 64))]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    low = packing.lower_bound(np.array([r.length for r in got]), 64)
    assert low <= len(bins) <= low + 1


def test_sequences_hold_the_ids(spark, messy):
    _, docs = messy
    got = packing.sequences(docs.where("doc_id < 12"), P.path("word_bpe_49k.json")).collect()
    assert all(len(r.ids) <= 4096 for r in got)
    encode = _encoder("word_bpe_49k.json")
    assert sum(len(r.ids) for r in got) == sum(len(encode(r.text, 1)) for r in docs.where("doc_id < 12").collect())


def test_lower_bound_never_exceeds_the_best_packing():
    rng = random.Random(4)
    for _ in range(300):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 8))]

        def fits(left, rooms):
            if not left:
                return True
            for k in range(len(rooms)):
                if rooms[k] >= left[0] and rooms.index(rooms[k]) == k:
                    if fits(left[1:], rooms[:k] + [rooms[k] - left[0]] + rooms[k + 1:]):
                        return True
            return False
        best = next(n for n in range(1, 9) if fits(sorted(sizes, reverse=True), [20] * n))
        low = packing.lower_bound(np.array(sizes), 20)
        _, _, used = packing.best_fit_decreasing(np.array(sizes), 20)
        assert low <= best <= used
    assert packing.lower_bound(np.array([11] * 6), 20) == 6         # beyond the plain sum
    assert packing.lower_bound(np.array([7] * 6), 20) == 3


def test_exchange_between_groups(spark):
    rng = random.Random(6)
    items = spark.createDataFrame([(k, rng.randint(200, 700)) for k in range(900)], "item long, length long")
    alone = packing.pack(items, 1000, group_items=30, rounds=0)
    more = packing.pack(items, 1000, group_items=30, rounds=4)
    for packed in (alone, more):
        rows = packed.collect()
        assert sorted(r.item for r in rows) == list(range(900))
        used = {}
        for r in rows:
            used[r.bin] = used.get(r.bin, 0) + r.length
        assert max(used.values()) <= 1000
    assert more.select("bin").distinct().count() <= alone.select("bin").distinct().count()


# ---------------------------------------------------------------- archives

PAGES = "page_id long, url string, html string, payload string, record_id string"


def test_warc_round_trip(spark, tmp_path):
    tricky = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>é\u0000"
    rows = [(1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, "same"), (2, "http://b\r\nX: y", tricky), (4, "u", None),
            (6, "u", ""), (None, "u", "same"), (7, "v", "x" * 300_000), (8, "v", "x" * 300_000), (9, "w", "only"), (9, "w", "only")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3)
    crawl, out = f"{tmp_path}/crawl", f"{tmp_path}/out"
    warc.write_responses(pages, crawl)
    warc.resolve_revisits(spark, crawl, out)
    got = warc.resolved_records(spark, out).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert sorted([(r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got]) == sorted(
        [(i or 0, len((t or "").encode()), digest(t)) for i, _, t in rows])
    by = {}
    for r in got:
        by.setdefault(r.payload_digest, []).append(r)
    for text, keep in (("same", 5), (tricky, 2), ("", 6), ("x" * 300_000, 8), ("only", 9)):
        group = by[digest(text)]
        assert [r.page_id for r in group if r.record_type == "response"] == [keep]
        assert all(r.refers_to == keep for r in group if r.record_type == "revisit")
    # payloads come back whole, each once
    full = warc.read_records(spark, out, with_payload=True).where("record_type = 'response'").collect()
    assert sorted(bytes(r.payload) for r in full) == sorted({(t or "").encode() for _, _, t in rows})
    # deduplicated archives resolve to themselves
    warc.resolve_revisits(spark, out, f"{tmp_path}/again")
    again = warc.resolved_records(spark, f"{tmp_path}/again").collect()
    key = lambda r: (r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0)
    assert sorted(map(key, again)) == sorted(map(key, got))
    # small payloads stay responses
    warc.resolve_revisits(spark, crawl, f"{tmp_path}/min", min_payload=10)
    least = warc.resolved_records(spark, f"{tmp_path}/min").collect()
    assert all(r.record_type == "response" for r in least if r.payload_bytes < 10)
    assert sum(r.record_type == "revisit" for r in least) == 1


def test_warc_reader_takes_members_and_plain_files():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n"
    for content in (record * 3, gzip.compress(record) * 3):
        assert [b for _, b in warc._records(content)] == [b"a\r\n\r\n"] * 3
    with pytest.raises(ValueError):
        list(warc._records(record[:-8]))


# ---------------------------------------------------------------- scans

def test_secret_battery_finds_random_strings(spark, messy):
    rng = random.Random(9)
    alpha = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows, planted = [], {}
    for i in range(60):
        token = "".join(rng.choice(alpha) for _ in range(rng.choice([40, 64, 90])))
        text = sentence(rng, 12) + " "
        planted[i] = (len(text), len(text) + len(token))
        rows.append((i, text + token + " " + sentence(rng, 5)))
    # no secrets: glued words, paths, separators, counters
    plain = ["".join(rng.choice(["tion", "the", "and", "ing", "re", "er"]) for _ in range(14)) for _ in range(60)]
    rows += [(100 + k, t) for k, t in enumerate(plain)]
    rows += [(200, "=" * 80), (201, "usr/share/doc/packages/information/reference/manual"), (202, "abcabcabc" * 9), (203, "a" * 60),
             (204, "0123456789" * 6), (205, None), (206, ""), (207, "Token=short password: 'x y' API_KEY = \"abcdef\" AKIA" + "A" * 15)]
    got = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    found = 0
    for i, (a, b) in planted.items():
        hits = [tuple(map(int, s.split(":")[1:])) for s in got[i].spans.split(",") if s.startswith("random")]
        found += any(x >= a and y <= b and y - x >= 0.8 * (b - a) for x, y in hits)
    assert found >= 54
    assert not any("random" in got[i].spans for i in got if i >= 100)
    assert (got[207].n_assign, got[207].n_access, got[207].n_hex) == (1, 0, 0)
    assert got[205].base_sha256 == hashlib.sha256(b"").hexdigest() and got[205].spans == ""
    _, docs = messy
    assert secret_scan.secrets(docs).count() == docs.count()


def test_secret_base_spans(spark):
    import re

    rng = random.Random(10)
    parts = ["token", "secret", ":", "=", " ", "\"", "'", "abcdef", "é", "x", "AKIA" + "Q" * 16, "AKIA", "0f" * 12, "0f" * 11,
             "api_key", "APIKEY", "passWd", "password", "\n", "a.b", "=="]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for i in range(400)]
    got = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, t in rows:
        s = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(s))
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), t
        assert got[i].n_assign == sum(k == 0 for _, k, _ in s)


def test_secret_candidates_of_mixed_runs(spark):
    """NAME=value lines, leading signs, and paths before a random string: the random string is tested."""
    rng = random.Random(14)
    alpha = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, planted = [], {}
    for i, (before, signs, after) in enumerate([("AWS_SECRET_ACCESS_KEY=", "+/", ""), ("PRIVATE_KEY=", "", "=="), ("==", "-_", ""),
                                                ("/some-path/", "+/", ""), ("a_b/c+", "-_", "="), ("x=y=", "+/", "=, z")] * 12):
        token = "".join(rng.choice(alpha + signs) for _ in range(64))
        text = sentence(rng, 6) + " "
        planted[i] = (len(text + before), len(text + before + token))
        rows.append((i, text + before + token + after))
    rows += [(100, "a=" * 2000), (101, "one_two/three+four-five" * 50), (102, "=" * 50 + "a" * 19 + "=b"), (103, "a" * 19 + "=")]
    got = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = 0
    for i, (a, b) in planted.items():
        hits = [tuple(map(int, s.split(":")[1:])) for s in got[i].spans.split(",") if s.startswith("random")]
        found += any(min(y, b) - max(x, a) >= 0.8 * (b - a) and y - x <= b - a + 8 for x, y in hits)
    assert found >= 64
    assert not any("random" in got[i].spans for i in got if i >= 100)
    cut = secret_scan.spans(spark.createDataFrame([(1, "=" * 3 + "b" * 25 + "=" + "c" * 19 + "==")], "_row long, text string"))
    assert sorted((r.start, r.end) for r in cut.collect() if r.kind == 3) == [(3, 28), (29, 50)]


def test_licenses(spark, messy):
    import re

    rng = random.Random(12)
    apache = license_scan.TEMPLATES["apache"][1]
    cut = apache.split()
    del cut[7]                                             # a word less: the diagonal moves by one
    rows = [(0, sentence(rng, 40)), (1, sentence(rng, 9) + "\n" + apache + "\n" + sentence(rng, 9)), (2, " ".join(cut)),
            (3, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
            (4, "the MIT license, the mit-License; GENERAL PUBLIC LICENSE"), (5, None), (6, ""), (7, "İ mit licenſe mit\nlicense"),
            (8, " ".join(apache.split()[:9])), (9, "Released under the MIT License. " * 3)]
    got = {r.doc_id: r for r in license_scan.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [k for p in license_scan.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (
            len(w), len(at), min(at, default=None), max(at, default=None))
        assert 0.0 <= got[i].score <= 1.0
    assert got[1].labels == "apache" and got[1].score == 1.0
    assert got[2].labels == "apache" and got[2].score > 0.9
    assert got[3].labels == "cc-by-sa" and got[3].base_labels == ""
    assert got[4].base_labels == "gpl,mit" and got[5].labels == "" and got[5].score == 0.0
    assert got[9].labels == "mit" and got[9].n_base == 3
    _, docs = messy
    assert license_scan.licenses(docs).count() == docs.count()


def test_licenses_of_more_families(spark):
    """Every entry of the table, word for word in other text, gives its own label beside those of the base phrases in it."""
    rng = random.Random(15)
    assert {"lgpl", "agpl", "isc", "cc0", "unlicense", "zlib", "boost", "busl"} <= set(license_scan.TEMPLATES)
    want = [(label, text) for label, texts in license_scan.TEMPLATES.items() for text in texts]
    rows = [(i, f"{sentence(rng, 9)}\n{text}\n{sentence(rng, 9)}") for i, (_, text) in enumerate(want)]
    got = {r.doc_id: (r.base_labels, r.labels) for r in license_scan.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, text) in enumerate(want):
        flat = " ".join(re.findall("[a-z0-9]+", text.lower()))
        base = {own for phrase, own in license_scan.PHRASES.items() if f" {phrase} " in f" {flat} "}
        assert got[i] == (",".join(sorted(base)), ",".join(sorted(base | {label})))
    assert ("gpl", "gpl,lgpl") in got.values()


def test_megabytes_of_license_text(spark):
    notice = license_scan.TEMPLATES["mit"][0]
    text = "\n".join([notice + " " + "filler words " * 20] * 3000)
    row = license_scan.licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert len(text) > 800_000 and row.n_base == 3000 and row.labels == "mit" and row.score == 1.0
