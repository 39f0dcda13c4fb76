"""Line dedup: sets of lines as bits, and the shuffled way beyond their limit."""

import random

import pytest

from recspark.llm import line_dedup

from tests.llm.conftest import sentence


@pytest.mark.parametrize("runs", [line_dedup.RUNS, 0])
def test_kept_against_sets(spark, monkeypatch, runs):
    monkeypatch.setattr(line_dedup, "RUNS", runs)
    rng = random.Random(4)
    uids = sorted({rng.randrange(5) << 33 | rng.randrange(70_000) for _ in range(900)} | {0, 63, 64, 32767, 32768, 65535})
    some = set(uids[::3]) | {63, 32768, 1 << 40}
    df = spark.createDataFrame([(u,) for u in uids], "uid long")
    keys = spark.createDataFrame([(u,) for u in [*some, *some]], "uid long")
    kept = line_dedup._kept(df, keys)
    assert sorted(r.uid for r in kept.collect()) == [u for u in uids if u in some]
    assert sorted(r.uid for r in line_dedup._kept(df, keys, inside=False).collect()) == [u for u in uids if u not in some]
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (runs > 0)


def test_likely_loses_no_token(spark):
    rng = random.Random(6)
    tokens = [rng.getrandbits(64) - (1 << 63) for _ in range(5_000)]
    df = spark.createDataFrame([(t,) for t in tokens], "token long")
    codes = df.limit(1_000).select(line_dedup._code(df.token).alias("token")).distinct()
    mine = {r.token for r in codes.collect()}
    got = {r.token for r in line_dedup._likely(df, codes).collect()}
    want = {t for t in tokens if t & ((1 << 40) - 1) in mine}
    assert want <= got and len(got) < len(want) + 400


@pytest.mark.parametrize("limit", [None, 0])
def test_frequent_tokens(spark, tmp_path, monkeypatch, limit):
    """Many lines share tokens; the result is the plain one with and without tables on all workers."""
    if limit is not None:
        monkeypatch.setattr(line_dedup, "FEW", limit)
    monkeypatch.setattr(line_dedup, "FREQUENT", 4)
    rng = random.Random(9)
    common = sentence(rng, 9)
    rows = [(i, "\n".join([common + " " + sentence(rng, 8), sentence(rng, 3) if i % 3 else "three words only", common, ""]))
            for i in range(30)]
    rows += [(i + 30, t.replace(common, common + " x")) for i, t in rows[::4]]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    got = {r._d.doc_id: r.kept_text for r in line_dedup.deduplicated(spark.read.parquet(f"{tmp_path}/d")).collect()}
    seen = []
    for i, t in rows:
        stay = []
        for line in t.split("\n"):
            w = line.lower().split()
            s = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            if not (s and any(4 * len(s & o) >= 3 * len(s | o) for o in seen)):
                stay.append(line)
            if s:
                seen.append(s)
        assert got[i] == "\n".join(stay)


def _plain(rows):
    """Kept lines where all lines have fewer than five words: copies of an earlier line go."""
    seen, out = set(), []
    for _, text in rows:
        stay = []
        for line in (text or "").split("\n"):
            words = tuple(line.lower().split())
            if not words or words not in seen:
                stay.append(line)
            seen.add(words)
        out.append(stay if text is not None else None)
    return out


@pytest.mark.parametrize("long,runs", [(False, line_dedup.RUNS), (True, line_dedup.RUNS), (True, 0)])
def test_no_text_is_shuffled_for_the_lines_that_go(spark, tmp_path, monkeypatch, long, runs):
    """Bits of a document's lines lie in one run, in two, or (documents of more than RUN lines) in several."""
    monkeypatch.setattr(line_dedup, "RUNS", runs)
    rng = random.Random(12)
    sizes = [1, 20_000, 0, 30_000, 3, 25_000] + ([90_000, 5] if long else [])
    rows = [(i, "\n".join(f"line {rng.randrange(60_000)}" for _ in range(n)) if n else None) for i, n in enumerate(sizes)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_dedup.deduplicated(spark.read.parquet(f"{tmp_path}/d"))
        got = {r._d.doc_id: r for r in out.collect()}
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for (i, text), kept in zip(rows, _plain(rows)):
        n = len(text.split("\n")) if text else 0
        want = (n, n - len(kept), "\n".join(kept)) if text else (0, 0, None)
        assert (got[i].n_lines, got[i].n_removed, got[i].kept_text) == want
    if not long:
        assert "SortMergeJoin" not in plan
