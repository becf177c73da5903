import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, position int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(3)
    base = [words(rng, n) for n in (3, 12, 40, 120, 300)]
    texts = [*base, base[3], base[3] + " tail", None, "", "   \n\t ", words(rng, 20_000), "Ünïcödé ß 測試 " * 8, "one", "a b c d e"]
    out = [(i, t, "en", f"src{i % 3}", len(t or ""), "clash", 7) for i, t in enumerate(texts)]
    out += [(None, base[2], None, None, None, None, None), (None, None, None, None, None, None, None), (4, base[4], "en", "src1", 1, "clash", 7), (4, base[4], "en", "src1", 1, "clash", 7), (3, base[1], "fr", "src0", 2, "x", 1)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
