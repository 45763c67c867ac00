import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    kinds = ["ba", "de", "mi", "no", "ru", "ta", "ke", "lo"]
    return " ".join("".join(rng.choice(kinds) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls in every column, empty, odd and very long texts, ties, copies and repeated rows."""
    base, shared = words(1, 200), words(2, 60)
    near = base.split()
    near[100] = "changed"
    out = [
        (0, base, "en", "a", 1), (1, base, "en", "a", 1), (2, " ".join(near), "en", None, None), (3, None, None, "b", 0), (4, "", "en", "b", 0),
        (5, " \t\n ", None, None, None), (6, words(3, 40) + "\n" + shared + " " + words(4, 10), "fr", "b", 5), (7, shared + " " + words(5, 80), "fr", "c", 5),
        (8, words(6, 12), "de", "c", 9), (8, words(6, 12), "de", "c", 9), (8, words(7, 30), "de", "c", 9), (None, base, None, "d", None), (None, None, None, None, None),
        (9, "one two three", "en", "a", 1), (10, "one two three", "en", "é", 1), (11, "😀 ▁ <|endoftext|> <s>[INST] \\  x \u0085 ﬁ", "es", "é", 1), (12, "!!! 123 ...", "es", "z", 1),
        (13, words(8, 20_000), "en", "a", 1), (14, "a" * 30_000, "en", "a", 1), (15, "the the the " * 50, "en", "a", 1), (-7, words(9, 25), "en", "a", 1), (1 << 60, words(9, 25), "en", "a", 1),
    ]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHING = ["ids", "id", "hash", "spans", "size", "units", "target", "copies", "source_size", "shard", "slot", "row", "part", "code", "score", "lang_pred", "kept", "n_words", "n_removed", "text_hash", "class_id", "node", "root", "prints", "decoded", "n_tokens"]


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with columns named like those that operators make."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])
