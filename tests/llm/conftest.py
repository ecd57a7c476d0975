import random

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty and long texts, copies, near copies, shared passages and a hot source."""
    rng = random.Random(3)
    rows = []
    passage = " ".join(words(rng, 60))
    base = " ".join(words(rng, 120))
    for i in range(90):
        text = " ".join(words(rng, rng.randrange(1, 90)))
        if i % 7 == 0:
            text += "\n" + passage
        if i % 11 == 0:
            text = base
        if i % 11 == 1:
            text = base.replace(base.split()[i % 100], "changed", 1)
        rows.append((i, text, ["en", "de", None][i % 3], "hot" if i % 3 else f"s{i % 4}", len(text)))
    rows += [(200, None, "en", "hot", 0), (201, "", "en", None, 0), (202, " \n\t ", None, None, 3), (203, "one", "en", "hot", 3),
             (204, " ".join(words(rng, 30000, 5000)), "en", "hot", 0), (205, "Ünïcödé ß 😀 " * 30, "fr", "s1", 0),
             (206, "a" * 500, "fr", "s1", 500), (207, "same line\nsame line\nsame line\n" * 20, "fr", "s1", 0)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC_SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, odd_rows):
    """The same documents with an extra column whose name an operator adds itself, a null id and a repeated row."""
    rows = [(*r, i % 2 == 0, float(i)) for i, r in enumerate(odd_rows[:40])]
    rows += [rows[3], (None, "text of no id " * 30, "en", "hot", 1, True, 1.0), (5, "another text of id five", "en", "hot", 1, True, 2.0)]
    return spark.createDataFrame(rows, DOC_SCHEMA + ", kept boolean, score double")
