import random

import pytest

#: Texts that every operator must take: nothing, blanks, one word, a long one, copies, other alphabets.
ODD = [None, "", " \t\n", "word", "a b", "long " * 4000, "same text here again", "same text here again", "Ünï çödé 漢字 \U0001f600 text", "x" * 5000]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, fp string, doc string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with NULL in every column, repeated rows, and extra columns named like internal ones."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", None, "r", None, "d") for i, t in enumerate(ODD)]
    rows += [rows[6], (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    """300 small documents: random ones, exact copies, near copies, and a passage that many share."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = []
    for i in range(300):
        kind = i % 6
        if kind == 1 and texts:
            texts.append(rng.choice(texts))
        elif kind == 2 and texts:
            parts = rng.choice(texts).split(" ")
            parts[rng.randrange(len(parts))] = rng.choice(words)
            texts.append(" ".join(parts))
        else:
            own = [rng.choice(words) for _ in range(rng.randint(1, 220))]
            if kind == 3:
                own.insert(rng.randrange(len(own) + 1), passage)
            texts.append(" ".join(own))
    rows = [(i, t, "en", f"s{i % 5}", len(t), "r", None, "d") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
