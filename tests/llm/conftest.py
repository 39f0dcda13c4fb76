import random

import pytest

#: Extra columns whose names the operators use inside.
CLASHING = ["row", "_row", "_d", "_f", "_host", "line", "code", "words", "set", "item", "kept", "mark", "gone",
            "n_words", "piece", "length", "text_mark", "task", "h", "spans"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def messy_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows and near copies."""
    rng = random.Random(5)
    body = "\n".join(sentence(rng, 30) for _ in range(4))
    other = "\n".join(sentence(rng, 30) for _ in range(3))
    edited = body.replace(body.split(" ")[40], "changed", 1)
    long_word = "x" * 50_000
    long_text = sentence(rng, 6_000)
    rows = [(0, body), (1, body), (2, edited), (3, other), (None, other), (None, body), (4, None), (5, ""), (6, "  \n\t "),
            (7, "one"), (8, "one"), (9, "four words only here"), (10, long_word), (11, long_text), (12, long_text),
            (13, "%% | ## $$ && " * 60), (14, "la la la " * 100), (3, other), (3, other),
            (15, other.upper()), (16, "a\x0bb\x0cc\rd\x1ce f g h i j  k"), (17, sentence(rng, 80)),
            (18, "same line of many words again and again here\n" * 20 + sentence(rng, 60))]
    out = []
    for k, (i, t) in enumerate(rows):
        out.append((i, t, "en" if k % 3 else None, f"h{k % 3}" if k % 4 else None, len(t) if t and k % 5 else None,
                    *[f"{c}{k}" if k % 2 else None for c in CLASHING]))
    return out


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    """The messy documents as a table read from files, with a benchmark beside it; the folder and the frame."""
    folder = tmp_path_factory.mktemp("messy")
    spark.createDataFrame(messy_rows(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None), (2, ""), (None, "short item"), (3, "la la la " * 9)],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder), spark.read.parquet(f"{folder}/documents.parquet")
