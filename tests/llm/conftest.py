import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that the operators use themselves
    "score double, ranges string, packed string, rep long, bucket long, slot long, m int, word string, `key` string"
)
EXTRA = (0.5, "r", "p", 1, 2, 3, 4, "w", "k")


def documents(spark, texts, langs=None):
    """(doc_id, text) pairs as a table with further, clashing columns."""
    rows = [
        (i, t, "en" if n % 2 else None, f"s{n % 3}" if n % 5 else None, None if t is None else len(t), *EXTRA)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.8)) % vocabulary}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, one very long text, copies, repeated rows, odd characters."""
    rng = random.Random(3)
    base = prose(rng, 120)
    texts = [(1, None), (2, ""), (3, " \n\t\x0b\x0c\r "), (4, "word"), (5, base), (6, base), (7, base + " more")]
    texts += [(8, "Ünï\x00cödé ▁ ﬁ 漢字 \U0001f600\x1c a\u00a0b <|endoftext|> <|ENDOFTEXT|>"), (9, base.upper())]
    texts += [(10, prose(rng, 60_000)), (11, "x" * 5000), (12, "ab " * 900), (None, base), (5, base)]
    return texts + [(20 + i, prose(rng, 150)) for i in range(12)]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_texts):
    return documents(spark, odd_texts).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
