import random

import pytest

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names that the operators use inside or give out
    "_key bigint, size int, score string, _row string, n_words string, kept int, _text string, _h1 bigint, _size int"
)
EXTRA = (7, 1, "s", "r", "w", 0, "t", 3, 4)


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def _rows():
    rng = random.Random(3)
    stock = ["the", "river", "cold", "stone", "maps", "über", "straße", "où", "niño", "日本", "fell", "again", "quiet"]

    def prose(n):
        return " ".join(rng.choice(stock) for _ in range(n))

    long_text = prose(40_000)
    near = prose(120).split()
    changed = [*near]
    changed[60] = "otherword"
    rows = [
        (1, prose(60), "en", "a"),
        (2, prose(60), "en", "a"),
        (3, " ".join(near), "de", "b"),
        (4, " ".join(changed), "de", None),
        (5, " ".join(near), "de", "b"),
        (6, long_text, "fr", "a"),
        (7, "", "fr", "c"),
        (8, None, None, None),
        (9, "  \n\t ", "fr", "c"),
        (10, "one two", None, "a"),
        (None, prose(30), "en", "a"),
        (None, None, None, None),
        (12, 'x token = "f3ef4d6b2755a36d7d9c25bd72c4d5f6" y', "en", "d"),
        (13, "line\nline\nline\n" + prose(25), "en", "d"),
    ]
    rows.append(rows[0])  # a repeated row
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge_rows():
    return _rows()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (6, 1, 0), (6, 0, None), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
