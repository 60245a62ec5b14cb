import random
import re

import pytest
from pyspark.sql import functions as F

from sievework.llm import decontaminate

WORDS = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id bigint, text string, _words string, _row int, doc_id string"


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def expected(docs, items, window=10):
    wanted = {}
    for item, text in items:
        found = words(text)
        n = min(window, len(found))
        for i in range(len(found) - n + 1 if n else 0):
            wanted.setdefault(tuple(found[i : i + n]), set()).add(item)
    sizes = {len(w) for w in wanted}
    out = []
    for key, text in docs:
        found, hit, held = words(text), set(), set()
        for n in sizes:
            for i in range(len(found) - n + 1):
                if owners := wanted.get(tuple(found[i : i + n])):
                    hit.update(range(i, i + n))
                    held |= owners
        out.append((key, len(found), len(hit), sorted(str(i) for i in held if i is not None)))
    return sorted(out, key=repr)


def run(spark, docs, items, schema="doc_id bigint, text string", **how):
    left = docs if not isinstance(docs, list) else spark.createDataFrame(docs, schema).repartition(3)
    right = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in decontaminate.decontaminate(left, right, **how).collect()), key=repr)


def test_random_passages(spark):
    rng = random.Random(8)
    stock = ["the", "of", "a", "River", "x1", "é", "日本語", "stone-cold", "it's", "9"]

    def prose(n):
        return " ".join(rng.choice(stock) for _ in range(n))

    items = [(i, prose(rng.randint(0, 25))) for i in range(60)]
    items += [(100, items[0][1]), (0, items[1][1]), (None, "one two three of four"), (101, None), (102, "!?"), (103, "river river " * 12)]
    docs = [(i, prose(rng.randint(0, 80))) for i in range(200)]
    for i in range(200, 300):
        passage = words(items[i % len(items)][1])
        begin = rng.randint(0, 5)
        docs.append((i, f"{prose(10)} {' ; '.join(passage[begin:]).upper()}, {prose(10)}"))
    docs += [(400, "River, river " * 40), (401, "One two three? Of four"), (402, "one two three four"), (None, None), (403, "")]
    docs.append(docs[-2])
    assert run(spark, docs, items) == expected(docs, items)
    assert run(spark, docs, items, window=4, shingle=2) == expected(docs, items, 4)


def test_edge_rows(spark, edge_docs, edge_rows):
    items = [(1, edge_rows[0][1]), (2, "one two"), (3, "zzz"), (4, edge_rows[5][1][5000:6000])]
    assert run(spark, edge_docs, items) == expected([(r[0], r[1]) for r in edge_rows], items)


def test_empty_tables(spark, empty_docs, edge_docs):
    assert run(spark, empty_docs, [(1, "a b c")]) == []
    assert {(r[2], tuple(r[3])) for r in run(spark, edge_docs, [])} == {(0, ())}


def test_a_passage_in_a_third_of_rows_and_long_words(spark):
    rng = random.Random(9)
    passage = [f"w{rng.randint(0, 50)}" for _ in range(40)]
    long = "語" * 300_000
    items = [(i, " ".join(passage)) for i in range(200)] + [(300, f"{long} b {long}c d"), (301, f"{long} b")]
    docs = [(i, " ".join(passage if i % 3 == 0 else [f"u{i}", f"w{i % 50}"] * 20)) for i in range(600)]
    docs += [(700, f"x {long} b {long}c d"), (701, f"x {long} c"), (702, f"{long}"), (703, " ".join(passage * 8_000))]
    found = run(spark, docs, items)
    assert found == expected(docs, items)


def test_keys_and_dotted_columns(spark):
    docs = spark.createDataFrame([("p", "a b c d", 1), ("q", "a c", 2)], ["my.id", "body", "meta.url"])
    found = run(spark, docs, [(5, "b c")], key="my.id", text="body")
    assert found == [("p", 4, 2, ["5"]), ("q", 2, 0, [])]


def test_rarest_shingle_is_the_prefix(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma delta") for i in range(5)] + [(9, "beta zeta eta")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "gamma beta zeta")], "item_id bigint, text string")
    windows = decontaminate.windows_of(items, 3, 1, "item_id", "text").withColumn("_window", F.lit(0).cast("bigint"))
    hashes = windows.select(F.explode("_hashes").alias("_hash"))
    counts = decontaminate.shingle_counts(docs.select("text"), [1], decontaminate.Bitmap(hashes, 3))
    # zeta stands in one document, gamma in five and beta in six.
    assert decontaminate.rarest_shingles(windows, counts).first()._offset == 2


def test_sizes_are_checked(spark, empty_docs):
    with pytest.raises(ValueError):
        decontaminate.decontaminate(empty_docs, empty_docs, window=64)


def test_spans_across_blocks(spark):
    spans = [(0, s, n) for s, n in ((0, 10), (60, 10), (65, 3), (120, 63), (118, 9))] + [(1, 128, 1)]
    table = spark.createDataFrame(spans, "_row bigint, _start bigint, _length bigint")
    wanted = {row: len({p for r, s, n in spans if r == row for p in range(s, s + n)}) for row in (0, 1)}
    assert {r._row: r._n_hit for r in decontaminate.hit_words(table).collect()} == wanted
