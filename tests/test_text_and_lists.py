from pyspark.sql import functions as F

from recspark.functions import text as T
from recspark.operators import evaluate as ev
from recspark.operators.keywords import format_keywords


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first().o


def test_tag_removal_does_not_cross_newline(spark):
    out = _one(spark, lambda c: F.regexp_replace(c, T.TAG_PATTERN, ""), "a <b>x</b> <i\n>z")
    assert out == "a x <i\n>z"
    assert _one(spark, T.clean, "The <b>Quick</b>  Fox ") == " quick fox"
    assert _one(spark, T.clean, "the a an") == ""
    assert _one(spark, T.clean_nodigits, "Version 12 of 3D") == " version d"


def test_vector_tokens_drop_one_letter(spark):
    assert _one(spark, T.vector_tokens, "z café 12") == ["café", "12"]
    assert _one(spark, T.word_tokens, "Héllo, a_b!") == ["h", "llo", "a_b"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "t array<string>")
    rows = df.select(T.ngrams(F.col("t"), 2).alias("g2"), T.ngrams(F.col("t"), 3).alias("g3")).collect()
    assert rows[0].g2 == ["a b", "b c"] and rows[0].g3 == ["a b c"]
    assert rows[1].g2 == [] and rows[1].g3 == []
    tagged = df.select(T.ngram_range(F.col("t"), 1, 3).alias("g")).first().g
    assert [(x.n, x.gram) for x in tagged] == [(1, "a"), (1, "b"), (1, "c"), (2, "a b"), (2, "b c"), (3, "a b c")]


def _lines(spark, values):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    rows = [(v, ("f", 0, i)) for i, v in enumerate(values)]
    schema = StructType([StructField("value", StringType()), StructField("line_order", StructType(
        [StructField("f", StringType()), StructField("b", LongType()), StructField("r", LongType())]))])
    return spark.createDataFrame(rows, schema)


def test_parse_recommendations_edge_cases(spark):
    p = ev.parse_recommendations(_lines(spark, ['"k",("com.a",40),("b-x",39)', '"j"', '"k",("z.z",1)']))
    lists = {r.key: (r.has_comma, r.recs) for r in p.lists.collect()}
    assert lists == {"k": (True, ["z.z"]), "j": (False, [])}
    dup = ev.duplicate_keys(p).collect()
    assert [(r.key, r.n_lines, r.kept_recs) for r in dup] == [("k", 2, 1)]
    tot = ev.rec_totals(p).first()
    assert (tot.total_recs, tot.number_lines, tot.unique_apps) == (4, 2, 2)


def test_list_eval_hand_computed(spark):
    recs = spark.createDataFrame([("k", 0, "x"), ("k", 1, "a")], "key string, pos int, other string")
    truth = spark.createDataFrame([("k", "a"), ("k", "b")], "key string, item string")
    r = ev.evaluate_lists(recs, recs.select("key"), truth, 2).first()
    assert abs(r.gain_sum / r.n_truth - 0.25) < 1e-12
    assert abs(r.score - 0.25 / 1.5 / 2) < 1e-12


def test_basket_eval_hand_computed(spark):
    recs = spark.createDataFrame([("k", 0, "a"), ("k", 1, "x")], "key string, pos int, other string")
    baskets = spark.createDataFrame([(1, "k"), (1, "a"), (1, "b")], "basket long, item string")
    r = ev.evaluate_baskets(recs, baskets, 2).first()
    assert abs(r.score - 0.5 / 0.75) < 1e-9
    only_key = spark.createDataFrame([(1, "k"), (1, "a"), (1, "b"), (2, "k")], "basket long, item string")
    r2 = ev.evaluate_baskets(recs, only_key, 2).first()
    assert r2.n_baskets == 2 and abs(r2.score - (0.5 / 0.75) / 2) < 1e-9


def test_keywords_format_trailing_comma(spark):
    kw = spark.createDataFrame([(1, 1, 1, "w", 3), (1, 2, 1, "a b", 2)],
                               "key long, n int, rank int, gram string, cnt long")
    keys = spark.createDataFrame([(1,), (2,)], "key long")
    lines = {r.key: r.line for r in format_keywords(kw, keys).collect()}
    assert lines[1] == '"1",("w":3,),("a b":2,),()'
    assert lines[2] == '"2",(),(),()'


def test_keywords_grouped_equals_relational(spark):
    from recspark.operators import keywords as K
    docs = spark.createDataFrame([(1, "red apple red pie <b>x</b>"), (2, "green apple pie 12"), (3, "red red apple")],
                                 "doc_id long, text string")
    nb = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 3), (3, 3)], "key long, other long")
    a = {tuple(r) for r in K.keywords(nb, K.gram_counts(docs, "doc_id", "text"), 3).collect()}
    b = {tuple(r) for r in K.keywords_grouped(nb, K.document_tokens(docs, "doc_id", "text"), 3).collect()}
    assert a == b and len(a) > 0


def test_run_names_from_files(spark, tmp_path):
    from recspark.sources.files import read_lines
    (tmp_path / "runA.txt").write_text('"k",("a.b",2)\n')
    (tmp_path / "runB.csv").write_text('"k",("c.d",2)\n"j"\n')
    df = read_lines(spark, str(tmp_path), with_run=True)
    assert sorted((r.run, r.value) for r in df.collect()) == [
        ("runA", '"k",("a.b",2)'), ("runB", '"j"'), ("runB", '"k",("c.d",2)')]
