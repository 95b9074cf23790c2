import random

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    pick = random.Random(seed)
    out = []
    for i in range(words):
        out.append(f"w{pick.randrange(vocabulary)}" + ("." if i % 9 == 8 else ""))
    return " ".join(out) + "."


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank, very long and repeated texts, ties and repeated rows."""
    long = prose(1, 30_000)
    same = prose(2, 120)
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (5, "a b c d"), (6, "a b c d e"),
        (7, same), (8, same), (8, same), (9, same + " tail words here"), (None, prose(3, 80)),
        (None, None), (10, long), (11, long[:-5]), (12, "Éé ñ ß 漢字 \U0001f600 #$%& |<>*"),
        (13, "x" * 50_000), (14, "\n\n\n"), (15, "A B c D e F g"), (16, "a b C d E f G"),
    ]
    return [(i, t, None if i == 7 else "en", None if i in (4, 8) else f"s{(i or 0) % 3}", None) for i, t in texts]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def clashing(df):
    """The same table with further columns, named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ("set_id", "class", "words", "key", "text_", "kept", "n_words", "size", "component_id", "row")
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
