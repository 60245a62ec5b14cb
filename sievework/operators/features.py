"""Text features as tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from sievework.functions.text import WORD
from sievework.operators import blocks
from sievework.operators.ranking import quota_cutoffs, running_totals, value_order
from sievework.session import stored

# A term is kept if it is in at least 3 documents and at most 95 % of them;
# a token has at least two word characters.
MIN_DF = 3
MAX_DF = 0.95
TOKEN = WORD + "{2,}"
# A vocabulary known to be at most this long is sent to every executor.
BROADCAST_TERMS = 500_000


def tokens(text: Column | str) -> Column:
    """Lower-case words of two or more characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def words_of(text: str, stop_words: Sequence[str] | str | None = None) -> Column:
    """The words of a text, a missing one having none, without ``stop_words``: words, or the name of a language whose list Spark has."""
    words = tokens(F.coalesce(F.col(text), F.lit("")))
    if isinstance(stop_words, str):
        stop_words = StopWordsRemover.loadDefaultStopWords(stop_words)
    return F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words


def with_terms(
    df: DataFrame,
    text: str,
    out: str = "terms",
    bigrams: bool = True,
    stop_words: Sequence[str] | str | None = None,
) -> DataFrame:
    """Add the array of words, followed by all pairs of neighbouring words."""
    tokenised = df.withColumn("_words", words_of(text, stop_words))
    if not bigrams:
        return tokenised.withColumnRenamed("_words", out)
    pairs = F.greatest(F.size("_words") - 1, F.lit(0))
    # Both sides are slices, so that the lambda needs nothing from outside it.
    bigram = F.zip_with(
        F.slice("_words", F.lit(1), pairs), F.slice("_words", F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)
    )
    return tokenised.withColumn(out, F.concat("_words", bigram)).drop("_words")


def tokenize_ngrams(df: DataFrame, text: str, key: str = "pmid", bigrams: bool = True) -> DataFrame:
    """One row per term occurrence: key and term."""
    return (
        with_terms(df.select(key, text), text, bigrams=bigrams)
        .select(key, F.explode_outer("terms").alias("term"))
        .filter(F.col("term").isNotNull())
    )


def term_counts(docs: DataFrame, key: str = "pmid", terms: str = "terms") -> DataFrame:
    """Rows (key, term, tf), made inside each document without a shuffle.

    The terms are sorted; a count is the distance between the starts of two runs.
    """
    sorted_terms = docs.select(key, F.sort_array(terms).alias("_s"), F.size(terms).alias("_n"))
    starts = F.filter(
        F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1)),
        lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)),
    )
    run = F.transform(
        "_starts",
        lambda start, i: F.struct(
            F.get("_s", start).alias("term"),
            (F.coalesce(F.get("_starts", i + 1), F.col("_n")) - start).cast("bigint").alias("tf"),
        ),
    )
    # The outer form: a plain inline would have the optimiser repeat the work in a filter.
    return (
        sorted_terms.withColumn("_starts", starts)
        .select(key, F.inline_outer(run))
        .filter(F.col("term").isNotNull())
    )


def count_documents(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def _within(totals: DataFrame, n_docs: Column | int, min_df: int, max_df: float) -> DataFrame:
    return totals.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))


def doc_frequency_prune(
    docs: DataFrame, text: str, min_df: int = MIN_DF, max_df: float = MAX_DF, bigrams: bool = True
) -> DataFrame:
    """Rows (term, df) of the terms that are neither too rare nor too common."""
    terms = with_terms(docs.select(text), text, bigrams=bigrams)
    once = terms.select(F.explode_outer(F.array_distinct("terms")).alias("term")).filter(F.col("term").isNotNull())
    return _within(once.groupBy("term").agg(F.count(F.lit(1)).alias("df")), count_documents(docs), min_df, max_df)


def limit_features(vocabulary: DataFrame, max_features: int, seed: int = 0) -> DataFrame:
    """The ``max_features`` most frequent terms by ``total_tf``; ties in MD5 order.

    ``vocabulary`` is read several times, so it should be a stored table. The
    smallest frequency that is kept comes from a count of terms per frequency;
    only the terms with just that frequency have to be told apart.
    """
    levels = vocabulary.groupBy("total_tf").agg(F.count(F.lit(1)).alias("_n"))
    level = (
        running_totals(levels, "total_tf", {"_upto": "_n"}, descending=True)
        .filter((F.col("_upto") > max_features) & (F.col("_upto") - F.col("_n") <= max_features))
        .first()
    )
    if level is None:
        return vocabulary
    edge, quota = level["total_tf"], max_features - (level["_upto"] - level["_n"])
    above = vocabulary.filter(F.col("total_tf") > edge)
    if quota == 0:
        return above
    order = value_order("term", seed)
    tied = vocabulary.filter(F.col("total_tf") == edge)
    quotas = vocabulary.sparkSession.createDataFrame([(edge, quota)], "total_tf bigint, quota bigint")
    cutoff = quota_cutoffs(tied.select("total_tf", order.alias("_order"), F.col("term").alias("_key")), "total_tf", quotas)
    inside = F.struct(order.alias("o"), F.col("term").alias("k")) <= F.struct(
        F.col("_last_order").alias("o"), F.col("_last_key").alias("k")
    )
    kept = tied.join(F.broadcast(cutoff), "total_tf").filter(inside)
    return above.unionByName(kept.select(*vocabulary.columns))


def fit_vocabulary(
    docs: DataFrame, text: str, min_df: int = MIN_DF, max_df: float = MAX_DF, max_features: int | None = None
) -> DataFrame:
    """Rows (term, df) of all terms within the document frequencies, or of the ``max_features`` most frequent ones."""
    return vocabulary_of(blocks.term_totals(docs, words_of(text)), count_documents(docs), min_df, max_df, max_features)


def vocabulary_of(totals: DataFrame, n_docs: Column | int, min_df: int, max_df: float, max_features: int | None) -> DataFrame:
    """As :func:`fit_vocabulary`, from rows (term, df, total_tf) of ``n_docs`` documents."""
    vocabulary = stored(_within(totals, n_docs, min_df, max_df))
    if max_features is not None:
        vocabulary = limit_features(vocabulary, max_features)
    return vocabulary.select("term", "df")


def tfidf(
    docs: DataFrame,
    text: str,
    key: str = "pmid",
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    bigrams: bool = True,
    sublinear: bool = False,
    stop_words: Sequence[str] | str | None = None,
    max_features: int | None = None,
) -> DataFrame:
    """Rows (key, term, tf, df, weight): tf * (ln((1+n)/(1+df)) + 1), scaled to length 1 per document.

    ``key`` names a document, so it must be distinct. The vocabulary is stored first. One of at most ``BROADCAST_TERMS``
    terms is sent to all executors, if the session allows broadcasts: a document's counts are then looked up, weighted and
    scaled where it is read, so that neither texts nor terms are shuffled. A longer one is joined to the distinct terms of
    blocks of documents. A session without broadcasts joins all counts; AQE splits the part of a term that is in very
    many documents. (Joined straight after its aggregation, it could not be split.)
    """
    n_docs = docs.count()
    words = words_of(text, stop_words)
    vocabulary = stored(_within(blocks.term_totals(docs, words, bigrams), n_docs, min_df, max_df))
    if max_features is not None:
        vocabulary = stored(limit_features(vocabulary, max_features))
    vocabulary = vocabulary.select("term", "df")
    if docs.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1":
        schema = StructType([
            StructField("key", docs.schema[key].dataType), StructField("term", StringType()), StructField("tf", LongType()),
            StructField("df", LongType()), StructField("weight", DoubleType()),
        ])
        if vocabulary.count() <= BROADCAST_TERMS:
            known = vocabulary.toArrow().combine_chunks()
            terms, df = (blocks._column(known, name) for name in known.column_names)

            def looked_up(keys, n, docs, places, tf):
                return _weighed(keys, n, docs, terms.take(pa.array(places)), df.to_numpy()[places], tf, n_docs, sublinear)

            weighed = blocks.in_rows(docs, words, key, bigrams, terms, looked_up, schema)
        else:

            def matched(row, n, docs, places, tf, hits):
                names, df = (hits.column(name).take(pa.array(places)).combine_chunks() for name in ("term", "df"))
                return _weighed(row.field(0), n, docs, names, df.to_numpy(), tf, n_docs, sublinear)

            rows = blocks.block_rows(docs, words, [key], bigrams)
            weighed = blocks.with_known_terms(rows, blocks.known_terms(rows, vocabulary, ["term", "df"]), "term", matched, schema)
        return weighed.withColumnRenamed("key", key)
    terms = with_terms(docs.select(key, text), text, bigrams=bigrams, stop_words=stop_words)
    raw = term_counts(terms, key).join(vocabulary, "term").withColumn(
        "_raw", _scaled_tf(F.col("tf"), sublinear) * (F.ln(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)
    )
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", "df", (F.col("_raw") / length).alias("weight"))


def _scaled_tf(tf: Column, sublinear: bool) -> Column:
    return (F.lit(1.0) + F.ln(tf)) if sublinear else tf.cast("double")


def _weighed(
    keys: pa.Array, n: int, docs: np.ndarray, names: pa.Array, df: np.ndarray, tf: np.ndarray, n_docs: int, sublinear: bool
) -> pa.Table:
    """Rows (key, term, tf, df, weight) of the counts ``tf`` of terms in ``n`` documents."""
    raw = (1.0 + np.log(tf) if sublinear else tf) * (np.log((1.0 + n_docs) / (1.0 + df)) + 1.0)
    length = np.sqrt(blocks.sums(docs, raw * raw, n))
    columns = [keys.take(pa.array(docs)), names, pa.array(tf, pa.int64()), pa.array(df, pa.int64()), pa.array(raw / length[docs])]
    return pa.table(columns, ["key", "term", "tf", "df", "weight"])


def top_terms_by_class(weights: DataFrame, labels: DataFrame, n: int = 20, key: str = "pmid") -> DataFrame:
    """The ``n`` terms of largest mean weight over the documents of each class.

    The mean is over all documents of the class; a document without the term counts 0.
    """
    labelled = labels.select(key, "label").filter(F.col("label").isNotNull())
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("_size"))
    sums = weights.join(labelled, key).groupBy("label", "term").agg(F.sum("weight").alias("_sum"))
    means = sums.join(sizes, "label").select(
        "label", "term", F.round(F.col("_sum") / F.col("_size"), 9).alias("mean_weight")
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("mean_weight"), "term"))
    return means.withColumn("rank", rank).filter(F.col("rank") <= n)
