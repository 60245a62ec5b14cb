import math
import re
from collections import Counter

import pytest

from sievework.catalog import feature_queries
from sievework.operators import features

TEXTS = [
    "The cat sat on the mat", "the cat ran", "A dog and the cat", "dog dog DOG the", "", None,
    "Élan vital of the café", "the_cat sat; the cat sat", "x y z", "sat sat on on the the",
]


def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "pmid bigint, text string").repartition(3)


def terms(text, stop=()):
    words = [w for w in re.findall(r"\w{2,}", (text or "").lower()) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(min_df, max_df, sublinear=False, stop=(), keep=None):
    counts = [Counter(terms(t, stop)) for t in TEXTS]
    df = Counter(t for c in counts for t in c)
    vocabulary = {t for t, n in df.items() if min_df <= n <= max_df * len(TEXTS)}
    if keep is not None:
        vocabulary &= keep
    out = {}
    for key, c in enumerate(counts):
        raw = {
            t: ((1 + math.log(n)) if sublinear else n) * (math.log((1 + len(TEXTS)) / (1 + df[t])) + 1)
            for t, n in c.items()
            if t in vocabulary
        }
        length = math.sqrt(sum(v * v for v in raw.values()))
        out |= {(key, t): v / length for t, v in raw.items()}
    return out


def weights(table):
    return {(r.pmid, r.term): r.weight for r in table.collect()}


@pytest.mark.parametrize("min_df, max_df", [(3, 0.95), (2, 0.5), (1, 1.0)])
def test_tfidf(spark, min_df, max_df):
    assert weights(features.tfidf(docs(spark), "text", min_df=min_df, max_df=max_df)) == pytest.approx(brute(min_df, max_df))


def test_options(spark):
    got = weights(features.tfidf(docs(spark), "text", min_df=1, max_df=1.0, sublinear=True, stop_words=["the", "on"]))
    assert got == pytest.approx(brute(1, 1.0, sublinear=True, stop=("the", "on")))


@pytest.mark.parametrize("limit", [1, 2, 5, 8, 1000])
def test_feature_limit_keeps_the_most_frequent(spark, limit):
    total = Counter(t for text in TEXTS for t in terms(text))
    table = features.tfidf(docs(spark), "text", min_df=1, max_df=1.0, max_features=limit)
    kept = {r.term for r in table.select("term").distinct().collect()}
    assert len(kept) == min(limit, len(total))
    assert sorted((total[t] for t in kept), reverse=True) == sorted(total.values(), reverse=True)[:limit]
    assert weights(table) == pytest.approx(brute(1, 1.0, keep=kept))


def test_query_with_options_weighs_every_term(spark, tmp_path):
    rows = [(i, " ".join(f"w{i // 3 * 30 + j}" for j in range(30))) for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    weights = feature_queries.tfidf_options(spark, str(tmp_path))
    # Each group of three documents has 30 words and 29 pairs of its own.
    assert weights.count() == 300 * 59 and weights.select("term").distinct().count() == 100 * 59


def test_prune_and_counts(spark):
    pruned = {r.term: r.df for r in features.doc_frequency_prune(docs(spark), "text", min_df=3).collect()}
    df = Counter(t for text in TEXTS for t in set(terms(text)))
    assert pruned == {t: n for t, n in df.items() if 3 <= n <= 9.5}
    rows = features.tokenize_ngrams(docs(spark), "text").collect()
    assert Counter((r.pmid, r.term) for r in rows) == Counter((i, t) for i, text in enumerate(TEXTS) for t in terms(text))


def test_counts_need_no_shuffle(spark):
    table = features.term_counts(features.with_terms(spark.createDataFrame(list(enumerate(TEXTS)), "pmid bigint, text string"), "text"))
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_top_terms(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "pmid bigint, label int")
    rows = features.top_terms_by_class(features.tfidf(docs(spark), "text", min_df=1), labels, n=3).collect()
    expected = brute(1, 0.95)
    for label in (0, 1):
        sums = Counter()
        for (key, term), w in expected.items():
            if key % 2 == label:
                sums[term] += w / 5
        best = sorted(sums.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:3]
        got = sorted((r for r in rows if r.label == label), key=lambda r: r.rank)
        assert [r.term for r in got] == [t for t, _ in best]
