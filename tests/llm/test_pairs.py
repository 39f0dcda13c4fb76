"""Operators 3, 7, 8, 10 against brute force, with their paths for large groups."""

import itertools
import random

import pytest

from recspark.llm import chosen_path, components, decontaminate, line_dedup, substring
from tests.llm.conftest import sentence


def _table(spark, tmp_path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/t.parquet")
    return spark.read.parquet(f"{tmp_path}/t.parquet")


def _near_copies(seed, groups=4, copies=40):
    """Groups of texts with growing distance from their base, chains included."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = sentence(rng, 60).split()
        now = list(base)
        for _ in range(copies):
            source = now if rng.random() < 0.3 else list(base)
            for _ in range(rng.randint(0, 3)):
                source[rng.randrange(len(source))] = sentence(rng, 1)
            now = source
            texts.append(" ".join(source))
    texts += [sentence(rng, 50) for _ in range(20)] + ["", None, "two words", "two words", "Two  Words"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def _brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


@pytest.mark.parametrize("leaf", [256, 6])
def test_chosen_path(spark, tmp_path, leaf):
    rows = _near_copies(leaf)
    got = chosen_path.components(_table(spark, tmp_path, rows), leaf=leaf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == _brute_components(rows)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert got == want


def _brute_substring(rows, window=20):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = (t or "").encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            g = tuple(w[s:s + window])
            if g in seen:
                gone.update(range(s, s + window))
            seen.add(g)
        out[i] = (len(w), len(gone), " ".join(x.decode() for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_substring(spark, tmp_path, hot):
    rng = random.Random(hot)
    shared = [sentence(rng, 45) for _ in range(3)]
    short = sentence(rng, 22)
    texts = []
    for _ in range(60):
        parts = [sentence(rng, rng.randint(0, 40)), rng.choice([*shared, short]), sentence(rng, rng.randint(0, 30))]
        if rng.random() < 0.3:
            parts.append(rng.choice(shared)[rng.randint(0, 60):])
        texts.append(" ".join(parts))
    texts += ["again " * 70, "again " * 30, "a b " * 40, None, "", texts[0], texts[0] + " tail", sentence(rng, 19)]
    rows = list(enumerate(texts))
    got = substring.deduplicated(_table(spark, tmp_path, rows), hot_passages=hot).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == _brute_substring(rows)


def test_suffix_automaton_statistics():
    rng = random.Random(1)
    seqs = [[rng.randrange(3) for _ in range(rng.randint(1, 30))] for _ in range(12)]
    text = [rng.randrange(3) for _ in range(80)]
    automaton = substring.SuffixAutomaton()
    for s in seqs:
        automaton.add(s)
    held = {tuple(s[a:b]) for s in seqs for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    want = [max([n for n in range(1, e + 2) if tuple(text[e + 1 - n:e + 1]) in held], default=0) for e in range(len(text))]
    assert automaton.matching_statistics(text) == want


def test_substring_messy(spark, messy):
    _, docs = messy
    got = substring.deduplicated(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 3)}
    assert by_id[1].n_removed == by_id[1].n_words and by_id[0].n_removed == 0
    assert by_id[4].n_words == 0 and by_id[10].n_words == 1
    assert by_id[16].n_words == 10           # other separators than the six are part of words
    third = [r for r in got if r.doc_id == 3]
    assert sorted(r.n_removed for r in third)[0] == 0 and sum(r.n_removed == 0 for r in third) == 1


def test_lines_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    base = [sentence(rng, 24) for _ in range(3)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(4):
            w = rng.choice(base).split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = sentence(rng, 1)
            lines.append(" ".join(w))
        rows.append((i, "\n".join([*lines, sentence(rng, 12), "short line", "\tShort  line" if i % 2 else "two lines short"])))
    got = {r._d.doc_id: r.kept_text for r in line_dedup.deduplicated(_table(spark, tmp_path, rows)).collect()}
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


QUESTION = ("If Alice buys 12 apples at 3 dollars each and sells them to Robert for 50 dollars, "
            "how much money does Alice make after paying 5 dollars for the market stall?")


def test_decontamination_templates(spark, tmp_path):
    rng = random.Random(2)
    renamed = QUESTION.replace("Alice", "Maria").replace("Robert", "Peter").replace("12", "30").replace("50", "99")
    mixed = QUESTION.replace("Alice buys", "Maria buys")             # Alice becomes Maria here and stays Alice there
    rows = [(0, sentence(rng, 60)), (1, sentence(rng, 30) + ". " + QUESTION), (2, renamed + " " + sentence(rng, 40)),
            (3, QUESTION.lower()), (4, mixed + "\n" + sentence(rng, 50)), (5, "1 2 3 4 5 6 7 8 9 10 " * 20), (6, None),
            (7, QUESTION[:60] + sentence(rng, 60)), (8, "12kg of 3 apples"), (9, "")]
    bench = spark.createDataFrame([(100, QUESTION), (101, "1 2 3 4 5 6 7 8 9 10 11 12"), (102, None), (103, "")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(_table(spark, tmp_path, rows), bench).collect()}
    assert {k for k in got if k[0] != 4} == {(1, 100), (2, 100), (3, 100)}
    assert got[1, 100].coverage == 1.0 and got[1, 100].n_changed == 0
    assert got[2, 100].n_changed >= 4
    tokens, plain, kinds = decontaminate.template("The car weighs 12kg. Then Anna drove 3.5 miles")
    assert tokens == ["the", "car", "weighs", "<num>", "<unit>", "then", "<name>", "drove", "<num>", "<unit>"]
    assert plain[3:5] == ["12", "kg"] and kinds[6] == 3


def test_decontamination_against_brute_force(spark):
    import duckdb

    from tests.conftest import SF_SMALL

    con = duckdb.connect()
    docs = con.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    items = con.sql(f"select item_id, text from '{SF_SMALL}/benchmark.parquet'").fetchall()
    want = set()
    for i, t in docs:
        tokens = decontaminate.template(t or "")[0]
        own = {tuple(tokens[k:k + 8]) for k in range(len(tokens) - 7)}
        for j, u in items:
            tokens = decontaminate.template(u or "")[0]
            grams = [tuple(tokens[k:k + 8]) for k in range(len(tokens) - 7)]
            if grams and 2 * sum(g in own for g in grams) >= len(grams):
                want.add((i, j))
    got = decontaminate.op3_decontamination(spark, SF_SMALL).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)


def test_decontamination_of_repeating_items(spark, tmp_path):
    """A template that repeats within a band hits itself on other diagonals; these hits veto nothing."""
    def question(days, pages):
        return " ".join(f"On day {d} she read {p} pages." for d, p in zip(days, pages)) + (
            " How many pages did she read on all of the days together?")
    item = question([1, 2, 3, 4], [12, 15, 20, 12])
    texts = {0: item, 100: question([5, 6, 7, 8], [31, 40, 52, 31]), 200: item.replace("On day 3", "On the very day 3")}
    rows = [(base + k, " ".join([*[f"word{j}" for j in range(k)], text])) for base, text in texts.items()
            for k in range(decontaminate.BAND)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(_table(spark, tmp_path, rows), bench).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, r in got.items():
        assert r.n_changed == (7 if 100 <= i < 200 else 0)
        assert r.coverage == 1.0 or i >= 200


def test_decontamination_of_short_and_number_heavy_items(spark, tmp_path):
    rng = random.Random(8)
    items = {1: "What is 17 + 25 - 3 * 4 / 2 + 96 - 8?", 2: "Name the biggest moon of Saturn.", 3: "Add 3 and 4.",
             4: "She packs 4 5 6 boxes of 7 8 9 then 3 4 5 more of 6 7 8 and sends 9 8 7 of them to the shop near her home in 3 2 1 days"}
    said = {1: (items[1], items[1].replace("17", "71")), 2: (items[2].lower(), items[2]), 3: ("so add 3 and 4.", items[3]),
            4: (items[4], items[4].replace("9", "11"))}
    rows = [(10 * k + j, f"{sentence(rng, 20)}.\n{t}\n{sentence(rng, 20)}") for k, ts in said.items() for j, t in enumerate(ts)]
    clean = [(90, "Add 5 and 6."), (91, "What is 17 + 25 for a moon of Saturn"), (92, "3 4 5 6 7 8 9 " * 20), (93, None), (94, "")]
    bench = spark.createDataFrame([*items.items(), (5, ""), (6, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in
           decontaminate.contaminated(_table(spark, tmp_path, rows + clean), bench).collect()}
    assert set(got) == {(i, i // 10) for i, _ in rows}
    assert got[11, 1].n_changed == 1 and got[41, 4].n_changed == 1 and got[10, 1].coverage == 1.0


def test_decontamination_of_names_at_sentence_starts(spark, tmp_path):
    """Names that stand only at sentence starts may change; starts that change unevenly veto nothing."""
    item = ("Tom buys 30 red apples at the market for his mother. Tom eats 4 of them on the way back home. "
            "Anna takes 6 of the apples that are left in the bag. Tom sells 9 of them to the man who lives next door. "
            "How many of the apples does he still have in the end?")
    changed = item.replace("Tom", "Ravi").replace("Anna", "Mei").replace("30", "52").replace("6", "8")
    uneven = "The " + item.replace("Tom sells", "Later he sells").replace("Tom eats", "He eats")
    texts = {0: item, 1: changed, 2: "so " + changed.replace(". ", ".\n"), 3: item.lower(), 4: uneven,
             5: changed.lower()}
    rows = [(k, t) for k, t in texts.items()] + [(9, "Tom eats. Anna takes. Tom sells. " * 20), (10, None), (11, "")]
    dense = ("Tom buys 30 red apples at noon. Tom eats 4 of them. Anna takes 6 of them home. Tom sells 9 on the market. "
             "How many are left?")
    rows += [(20, dense.replace("Tom", "Ravi").replace("Anna", "Mei").replace("30", "52").replace("6", "8"))]
    bench = spark.createDataFrame([(1, item), (2, None), (3, dense)], "item_id long, text string")
    every = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(_table(spark, tmp_path, rows), bench).collect()}
    assert every[20, 3].n_changed == 4 and every[20, 3].coverage >= 0.5
    got = {i: r for (i, j), r in every.items() if j == 1}
    assert set(every) == {*((i, 1) for i in got), (20, 3)}
    assert set(got) == {0, 1, 2, 3, 4, 5}
    assert got[0].coverage == got[3].coverage == 1.0 and got[0].n_changed == got[3].n_changed == 0
    assert got[1].coverage == 1.0 and got[1].n_changed == 4


def test_templates_of_batches_are_those_of_single_texts():
    """Texts cut together, with a memo that is emptied often, give what each gives alone."""
    rng = random.Random(11)
    bits = ["12kg", '"Tom', "Miles", "miles", "5", "-", ".", "The", "the", "$5.", "+3", "One", "x", "\n", "12%", "'Ann.'", "h", "(h)"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(400)]
    words = decontaminate.Words(limit=7)
    for k in range(0, 400, 50):
        ids, kind, owner = words.of(texts[k:k + 50])
        got = {(t, p, q) for t, p, q in zip(owner.tolist(), [words.plain[i] for i in ids.tolist()], kind.tolist())}
        sizes = [int((owner == t).sum()) for t in range(50)]
        alone = [decontaminate.template(t) for t in texts[k:k + 50]]
        assert sizes == [len(a[0]) for a in alone]
        assert got == {(t, p, q) for t, a in enumerate(alone) for p, q in zip(a[1], a[2])}
        forms = words.codes(ids, kind)
        at, code, form = decontaminate._windows(forms, kind, owner, 3, 1)
        first = [sum(sizes[:t]) for t in range(50)]
        many = {(int(owner[p]), int(p) - first[owner[p]], int(c), int(f)) for p, c, f in zip(at, code, form)}
        single = set()
        for t, text in enumerate(texts[k:k + 50]):
            w = decontaminate.Words()
            own, kinds, zero = w.of([text])
            single |= {(t, int(p), int(c), int(f)) for p, c, f in zip(*decontaminate._windows(w.codes(own, kinds), kinds, zero, 3, 1))}
        assert many == single


@pytest.mark.parametrize("width", [1, 2, 8, 13, 40])
def test_long_codes_are_window_codes(width):
    import numpy as np

    codes = np.random.default_rng(1).integers(0, 1 << 63, 40).astype(np.uint64) * np.uint64(2)
    assert decontaminate.long_codes(codes, width).tolist() == decontaminate.window_codes(codes, width).tolist()
