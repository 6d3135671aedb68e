import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, id string, h string, size string, maybe string, spans string"


def make_docs():
    """Nulls in every column, empty and long texts, ties, repeated rows, copies that hold a third of all rows, near copies."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    hot, passage = body(60), body(30)
    texts = [None, "", " \t\n ", "one", "one two", "One TWO", "é É ß İ", "MIT License", "cc by mit license", body(9000), "x" * 5000, "a b " * 600]
    texts += [hot] * 25 + [hot.upper(), hot + " tail", hot.replace(" ", "\n", 3)]
    texts += [f"{body(20)} {passage} {body(10)}" for _ in range(10)]
    texts += [body(rng.randint(1, 120)) for _ in range(25)]
    near = body(100).split()
    for i in range(60):  # near copies, more than one region compares at once
        own = list(near)
        own[rng.randrange(100)] = f"edit{i}"
        texts.append(" ".join(own))
    rows = [(i if i % 17 else None, t, None if i % 11 == 0 else "en", None if i % 7 == 0 else f"s{i % 4}", None, *["x"] * 7) for i, t in enumerate(texts, 1)]
    return rows + [rows[20], rows[20], rows[3], (5, "another text of the same id " + passage, "en", "s1", 3, *["y"] * 7)]


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "e.parquet")
    docs.limit(0).write.parquet(path)
    return docs.sparkSession.read.parquet(path)
