"""Each stage on messy rows: columns stay, decisions take effect, nothing clean is lost."""

import pytest

import corpus_pipeline
from recspark.llm import chosen_path, line_dedup, quality
from tests.llm.conftest import CLASHING

STAGES = dict(corpus_pipeline.STAGES)


def _run(spark, messy, name):
    folder, docs = messy
    out = STAGES[name](spark, docs, folder)
    if name != "packing":
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    return [r.asDict() for r in out.collect()], [r.asDict() for r in docs.collect()]


def test_quality(spark, messy):
    got, rows = _run(spark, messy, "quality rules")
    texts = {r["text"] for r in got}
    assert not texts & {None, "", "one", "four words only here"}
    assert not any(t.startswith(("%%", "la la")) for t in texts)
    body = [r for r in rows if r["doc_id"] == 0][0]["text"]
    assert sum(r["text"] == body for r in got) == sum(r["text"] == body for r in rows)      # copies are not its business
    whole = [r for r in rows if r["doc_id"] in (11, 12, 17)]
    assert [r for r in got if r["doc_id"] in (11, 12, 17)] and all(r in got for r in whole)


def test_lines(spark, messy):
    got, rows = _run(spark, messy, "line dedup")
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    first = [r for r in rows if r["doc_id"] == 0][0]
    assert by_id[0] == [first]
    assert 1 not in by_id and 12 not in by_id           # nothing but repeated lines
    assert len(by_id[2][0]["text"].split("\n")) == 1    # the changed line: 21 of 31 shingles are the same
    assert len(by_id[3]) == 1                           # the table's first of three equal rows
    assert None not in by_id                            # null ids come last
    assert 15 not in by_id                              # case does not matter
    assert {4, 5, 6, 7, 9} <= set(by_id)                # no words, or the first of its kind
    assert 8 not in by_id                               # a copy of one word
    kept = by_id[18][0]
    assert kept["text"].count("same line of many words") == 1
    assert kept["n_chars"] == len(kept["text"])


def test_near_duplicates(spark, messy):
    got, rows = _run(spark, messy, "near-duplicates")
    ids = [r["doc_id"] for r in got]
    assert ids.count(0) == 1 and ids.count(1) == 0 and ids.count(2) == 0
    assert ids.count(3) == 1 and None not in ids and 15 not in ids
    assert ids.count(7) == 1 and 8 not in ids and 12 not in ids
    assert {4, 5, 6, 9, 10, 11, 13, 14, 16, 17, 18} <= set(ids)
    assert all(r in rows for r in got)


def test_decontamination(spark, messy):
    got, rows = _run(spark, messy, "decontamination")
    gone = [r for r in rows if r not in got]
    assert [r["doc_id"] for r in gone] == [14]
    assert len(got) == len(rows) - 1


def test_packing(spark, messy):
    got, rows = _run(spark, messy, "packing")
    assert len({r["doc_id"] for r in got}) == len({r["doc_id"] for r in rows})
    assert sum(r["piece"] == 0 for r in got) == len(rows)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty(spark, empty, name):
    folder, docs = empty
    out = STAGES[name](spark, docs, folder)
    assert out.collect() == []
    assert name == "packing" or out.columns == docs.columns


def test_inner_frames_do_not_clash(spark, messy):
    _, docs = messy
    assert set(CLASHING) <= set(docs.columns)
    assert quality.judged(docs).count() == docs.count()
    assert line_dedup.deduplicated(docs).count() == docs.count()
    flat = docs.select("doc_id", "text", "kept", "set")
    assert chosen_path.components(flat).count() == docs.count()


def _plain_pipeline(path, folder):
    """The stages in plain Python: (doc_id) that reach packing, and their texts."""
    import re
    from collections import Counter

    import duckdb

    from recspark.llm.decontaminate import template
    from recspark.llm.quality import _beta_prior

    con = duckdb.connect()
    docs = con.sql(f"select doc_id, text, source from '{path}' order by doc_id").fetchall()
    items = con.sql(f"select item_id, text from '{folder}/benchmark.parquet'").fetchall()
    word = re.compile(r"[^\x20\x09-\x0D]+")

    # quality
    facts = []
    for i, t, s in docs:
        w = word.findall(t or "")
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        count = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if word.search(x)]
        base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        facts.append((i, t, s, base, symbols, len(w), len(lines) - len(set(lines)), len(lines)))

    def breaks(x, f):
        return x[4] > f * 0.10 * x[5] or x[6] > f * 0.30 * x[7]
    hosts = {}
    for x in facts:
        n, f = hosts.get(x[2], (0, 0))
        hosts[x[2]] = (n + 1, f + (x[3] or breaks(x, 1.0)))
    mean, size = _beta_prior({"k": len(hosts), "n": sum(n for n, _ in hosts.values()), "f": sum(f for _, f in hosts.values()),
                              "nn": sum(n * n for n, _ in hosts.values()), "ff": sum(f * f / n for n, f in hosts.values())})
    strict = {h: (f + mean * size) / (n + size) > 0.5 for h, (n, f) in hosts.items()}
    kept = [(x[0], x[1]) for x in facts if not x[3] and not breaks(x, 0.5 if strict[x[2]] else 1.0)]

    # lines
    seen, out = [], []
    for i, t in kept:
        lines, stay, gone = t.split("\n"), [], 0
        for line in lines:
            w = word.findall(line.lower())
            s = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            if s and any(4 * len(s & o) >= 3 * len(s | o) for o in seen):
                gone += 1
            else:
                stay.append(line)
            if s:
                seen.append(s)
        text = "\n".join(stay)
        if not gone or word.search(text):
            out.append((i, text))

    # near-duplicates
    sets = []
    for i, t in out:
        w = t.encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(out)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for b in range(len(out)):
        for a in range(b):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    out = [x for k, x in enumerate(out) if find(k) == k]

    # decontamination
    wanted = []
    for _, t in items:
        tokens = template(t or "")[0]
        wanted.append([tuple(tokens[k:k + 8]) for k in range(len(tokens) - 7)])
    clean = []
    for i, t in out:
        tokens = template(t)[0]
        own = {tuple(tokens[k:k + 8]) for k in range(len(tokens) - 7)}
        if not any(g and 2 * sum(x in own for x in g) >= len(g) for g in wanted):
            clean.append((i, t))
    return clean


def test_pipeline_against_plain_python(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from tests.conftest import SF_SMALL

    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    want = _plain_pipeline(f"{SF_SMALL}/documents.parquet", SF_SMALL)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for i, t in want:
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            pieces[i, k] = (at, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == pieces
    assert len(got) == len(pieces)
