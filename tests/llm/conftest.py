from __future__ import annotations

import random

import pytest

EXTRA = "id long, sig long, piece long, row long, h string, size long, label int, archive string, score double, target double, key long, train boolean, words string, n long"


def words(r, n):
    return " ".join("".join(r.choice(["er", "th", "on", "an", "ing", "re"]) for _ in range(r.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with every odd case: null, empty, blank, one word, repeats, near copies, a very long one."""
    r = random.Random(5)
    base = words(r, 120).split()
    out = [None, "", "  \n\t ", "one", "two words", "É é ß", "A b\x0bC d", "x" * 5000]
    out += [words(r, r.randrange(1, 60)) for _ in range(40)]
    out += [" ".join(base), " ".join(base).upper(), " ".join(base[:60] + ["zzz"] + base[61:]), " ".join(base[:40] + ["q"] * 30 + base[70:])]
    out += [words(r, 30000)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """documents with repeated rows, a null id, null columns and extra columns whose names operators use inside."""
    rows = [(i, t, ["en", None][i % 2], [None, "s1", "s2", "s3", "S"][i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, texts[9], "en", "s1", 3), (500, texts[12], "en", "s1", 3), (501, texts[12], "en", "s1", 3)]
    extra = (7, 7, 7, 7, "h", 7, 1, "a", 0.5, 0.5, 7, True, "w", 7)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
