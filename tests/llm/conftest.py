import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, id string, node string, score double"


def edge_rows():
    """Nulls in any column, empty and blank texts, long texts, ties, repeated rows."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, shared = say(120), say(60)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "One two"), (5, "one  two"), (6, "ONE two"),
            (7, base), (8, base), (8, base), (9, base.upper()), (10, base + " tail end"), (11, base.replace(" ", "\n", 9)),
            (None, base), (None, None), (12, say(30000)), (13, "x" * 9000), (14, "é È ÿ × ÷ ß " * 20), (15, "it's <|endoftext|> İ ǅ \u0301a"),
            (16, "line a b\nline a b\nline a b\n" * 5), (17, "%%% $$$ ### word " * 30), (18, "SHOUT LOUD WORDS HERE " * 20),
            (19, "a\x00b \x1c c\x85d \u00a0 e"), (20, "日本語 テスト 🙂")]
    rows += [(100 + i, shared + " " + say(40)) for i in range(12)]
    rows += [(200 + i, base + " " + say(3)) for i in range(12)]
    words = say(100).split()
    for i in range(25):  # a chain: neighbours are alike, the ends are not
        words[(4 * i) % 100] = f"w{i}"
        rows.append((300 + i, " ".join(words)))
    return [(i, t, [None, "en", "fr"][k % 3], [None, "hot", "hot", f"s{k % 5}"][k % 4], None, 7, "x", None, 0.5)
            for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs001(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
