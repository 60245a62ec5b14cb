"""Registered queries: terms, TF-IDF, classifier and tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.catalog import base
from sievework.catalog.metric_queries import PLACES, rounded, sql_report
from sievework.catalog.model_sql import coefficients_sql, linear_sql, meta_sql, tree_ctes, tree_rules_sql
from sievework.functions.scores import META_COLUMNS, predicted
from sievework.functions.text import build_text
from sievework.operators import features, labels as label_ops, metrics, models
from sievework.operators.features import MAX_DF, MIN_DF
from sievework.operators.sampling import stratified_split
from sievework.plans import training
from sievework.session import scratch_path, settle, stored
from sievework.sources import runs

# The steepest slope per training row that counts as an optimum.
GRADIENT_BOUND = 1e-3
# The English stop words of Spark that can be tokens (two letters or more, no apostrophe).
ENGLISH = """
me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it
its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not
only own same so than too very can will just don should now cannot could ought would
""".split()


def _docs(spark, sf):
    return base.table(spark, sf, "documents").select(F.col("doc_id").alias("pmid"), "text")


def tokenize_ngrams(spark, sf):
    """Number of times each term stands in each document."""
    docs = features.with_terms(_docs(spark, sf), "text")
    return features.term_counts(docs)


def doc_frequency_prune(spark, sf):
    return features.doc_frequency_prune(_docs(spark, sf), "text")


def tfidf(spark, sf):
    return rounded(features.tfidf(_docs(spark, sf), "text"), "weight")


def tfidf_options(spark, sf):
    """Sublinear weights without stop words, of all terms within the document frequencies."""
    return rounded(features.tfidf(_docs(spark, sf), "text", sublinear=True, stop_words="english"), "weight")


def top_terms(spark, sf):
    """Labels joined to documents, TF-IDF over the labelled ones, top 20 terms of each class."""
    joined = stored(label_ops.join_labels(base.labels(spark, sf), _docs(spark, sf)).select("pmid", "label", "text"))
    return rounded(features.top_terms_by_class(features.tfidf(joined, "text"), joined), "mean_weight")


def _labelled(spark, sf, phrases=False):
    """Labelled records with their split, stored once for the steps that follow."""
    rec = base.records(spark, sf, phrases).select("pmid", "title", "abstract", *META_COLUMNS)
    return settle(stratified_split(label_ops.join_labels(base.labels(spark, sf), rec)))


# What is read of the labelled records besides their texts.
READ = ["pmid", "label", "is_test", *META_COLUMNS]


def _trained(rows):
    return models.train_logistic(models.stack_features(rows, keep=READ), rows, held_out="is_test")


def stack_features(spark, sf):
    """Per labelled record: terms in the text block, length of that block, and the meta block, all read from the vectors."""
    rows = _labelled(spark, sf)
    stacked = models.stack_features(rows, keep=READ)
    n_terms = stacked.terms.n_terms
    entries = models.vector_entries(stacked.computed(rows, ["pmid"], {"features": "features"}))
    in_text = (F.col("place") < n_terms) & (F.col("value") != 0)
    return entries.groupBy("pmid").agg(
        F.count_if(in_text).alias("n_terms"),
        F.round(F.coalesce(F.sum(F.when(in_text, F.col("value") * F.col("value"))), F.lit(0.0)), PLACES).alias("text_norm"),
        *(
            F.coalesce(F.max(F.when(F.col("place") == n_terms + i, F.col("value"))), F.lit(0.0)).alias(c)
            for i, c in enumerate(META_COLUMNS)
        ),
    )


def train_logistic(spark, sf):
    """Metrics of the classifier on the test part."""
    rows = _labelled(spark, sf)
    scored = models.score_logistic(_trained(rows), rows, keep=["pmid", "label", "is_test"]).withColumn("pred", predicted())
    return metrics.metrics_row(settle(scored))


def logistic_optimum(spark, sf):
    """Size of the fitted model, and whether the loss is flat at its coefficients."""
    rows = _labelled(spark, sf)
    train = rows.filter(~F.col("is_test"))
    model = _trained(rows)
    steepest = models.loss_gradient(model, rows, held_out="is_test").agg(F.max(F.abs("slope"))).first()[0]
    return train.agg(
        F.count(F.lit(1)).alias("n_train"),
        F.lit(model.terms.width - 1).cast("bigint").alias("n_features"),
        (F.lit(float(steepest)) < GRADIENT_BOUND * F.count(F.lit(1))).alias("flat"),
    )


def _weights_of(names):
    """A weight from -2 to 2 for each feature, which follows from its name."""
    number = F.conv(F.substring(F.md5("feature"), 1, 6), 16, 10).cast("bigint")
    return names.select("feature", ((number % 2001 - 1000) / F.lit(500.0)).alias("weight"))


def _weighed(spark, sf):
    """A classifier with given weights, and the labelled rows."""
    rows = _labelled(spark, sf)
    stacked = models.stack_features(rows, keep=READ)
    return models.from_weights(stacked, _weights_of(stacked.terms.names())), rows


def score_logistic(spark, sf):
    """Probability for every document, labelled or not, by a model with given weights."""
    model, _ = _weighed(spark, sf)
    rec = base.records(spark, sf).select("pmid", "title", "abstract", *META_COLUMNS)
    return rounded(models.score_logistic(model, rec, keep=["pmid"]), "model_prob")


def score_by_table(spark, sf):
    """The same probabilities from tables of terms and weights, by joins."""
    rows = _labelled(spark, sf)
    vocabulary = stored(features.fit_vocabulary(rows.select(build_text().alias("text")), "text"))
    names = vocabulary.select(F.col("term").alias("feature")).unionByName(
        spark.createDataFrame([(models.META_PREFIX + c,) for c in META_COLUMNS] + [(models.INTERCEPT,)], "feature string")
    )
    rec = base.records(spark, sf).select("pmid", "title", "abstract", *META_COLUMNS)
    scored = models.score_by_table(rec, vocabulary, rows.count(), stored(_weights_of(names)))
    return rounded(scored.select("pmid", "model_prob"), "model_prob")


def top_coefficients(spark, sf):
    return models.top_coefficients(_weighed(spark, sf)[0])


def meta_coefficients(spark, sf):
    return models.meta_coefficients(_weighed(spark, sf)[0])


def save_model(spark, sf):
    """Probabilities of the labelled records by a model that was stored and read again; whether a trained one scores as before it was stored."""
    model, rows = _weighed(spark, sf)
    trained = models.train_logistic(models.TermModel([model.terms]), rows, held_out="is_test")
    paths = [scratch_path(spark, "model") for _ in range(2)]
    for fitted, path in zip((model, trained), paths):
        runs.save_model(fitted, path)
    given, again = map(runs.load_model, paths)
    scored = models.score_logistic(again, models.score_logistic(trained, rows, "_fresh"), "_stored")
    scored = models.score_logistic(given, scored, keep=["pmid", "_fresh", "_stored"])
    return rounded(scored.select("pmid", "model_prob", (F.col("_fresh") == F.col("_stored")).alias("same")), "model_prob")


def load_model(spark, sf):
    """Top coefficients read from a stored model."""
    path = scratch_path(spark, "model")
    runs.save_model(_weighed(spark, sf)[0], path)
    return models.top_coefficients(runs.load_model(path))


def _tree(spark, sf):
    rows = training.flagged(_labelled(spark, sf, phrases=True))
    return models.train_tree(rows.filter(~F.col("is_test"))), rows


def train_tree(spark, sf):
    """Report of the tree on the test part."""
    tree, rows = _tree(spark, sf)
    return rounded(metrics.classification_report(models.score_tree(tree, rows.filter("is_test"))), "precision", "recall", "f1")


def score_tree(spark, sf):
    tree, rows = _tree(spark, sf)
    return models.score_tree(tree, rows).select("pmid", "label", "is_test", "pred")


def tree_rules(spark, sf):
    return models.tree_rules(_tree(spark, sf)[0])


def _run(spark, sf):
    return training.train(base.seed_labels(spark, sf).select("pmid", "label"), base.records(spark, sf))


def end_to_end_metrics(spark, sf):
    """The whole run over labels and records: the metrics row."""
    return _run(spark, sf).metrics


def end_to_end_audit(spark, sf):
    """The same run: all labelled rows in the order of the audit, with the model's probabilities."""
    return _run(spark, sf).audit.drop("title", "abstract")


def end_to_end_unlabeled(spark, sf):
    """The same run: the scored sample of rows without a label."""
    return _run(spark, sf).unlabeled.drop("title", "abstract")


_WORD = r"[\p{L}\p{N}_]{2,}"


def _terms_cte(source: str = "SELECT doc_id AS pmid, text FROM documents", stop=()) -> str:
    """``docs``, ``term_rows`` (pmid, term) and ``counts`` (pmid, term, tf)."""
    words = f"regexp_extract_all(lower(coalesce(text, '')), '{_WORD}')"
    if stop:
        listed = ", ".join("'" + w.replace("'", "''") + "'" for w in stop)
        words = f"[w FOR w IN {words} IF w NOT IN ({listed})]"
    return f"""
    docs AS ({source}),
    word_rows AS (SELECT pmid, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT pmid, {words} AS w FROM docs)),
    term_rows AS (
      SELECT pmid, w AS term FROM word_rows
      UNION ALL
      SELECT a.pmid, concat(a.w, ' ', b.w) FROM word_rows a JOIN word_rows b ON a.pmid = b.pmid AND b.i = a.i + 1),
    counts AS (SELECT pmid, term, count(*) AS tf FROM term_rows GROUP BY pmid, term),
    vocabulary AS (
      SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM counts GROUP BY term
      HAVING count(*) >= {MIN_DF} AND count(*) <= {MAX_DF} * (SELECT count(*) FROM docs))"""


def _weights(tf: str) -> str:
    return f"""
    raw_weights AS (
      SELECT pmid, term, tf, df, {tf} * (ln((1.0::DOUBLE + (SELECT count(*) FROM docs)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS raw
      FROM counts JOIN vocabulary USING (term)),
    weights AS (SELECT pmid, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY pmid)) AS weight FROM raw_weights)"""


_WEIGHT_ROWS = " SELECT pmid, term, tf, df, round(weight, 6) AS weight FROM weights"
_LABELLED = "SELECT doc_id AS pmid, quality AS label, text FROM labels LEFT JOIN documents USING (doc_id)"

QUERIES = {
    "tokenize_ngrams": (tokenize_ngrams, "WITH " + _terms_cte() + " SELECT pmid, term, tf FROM counts"),
    "doc_frequency_prune": (doc_frequency_prune, "WITH " + _terms_cte() + " SELECT term, df FROM vocabulary"),
    "tfidf": (tfidf, "WITH " + _terms_cte() + "," + _weights("CAST(tf AS DOUBLE)") + _WEIGHT_ROWS),
    "tfidf_options": (
        tfidf_options,
        "WITH " + _terms_cte(stop=ENGLISH) + "," + _weights("(1 + ln(tf))") + _WEIGHT_ROWS,
    ),
    "top_terms": (
        top_terms,
        "WITH " + _terms_cte(_LABELLED) + "," + _weights("CAST(tf AS DOUBLE)") + """,
    means AS (
      SELECT label, term, round(sum(weight) / any_value(n_c), 9) AS mean_weight
      FROM weights JOIN docs USING (pmid) JOIN (SELECT label, count(*) AS n_c FROM docs GROUP BY label) USING (label)
      GROUP BY label, term)
    SELECT label, term, round(mean_weight, 6) AS mean_weight,
           CAST(row_number() OVER (PARTITION BY label ORDER BY mean_weight DESC, term) AS INTEGER) AS rank
    FROM means QUALIFY rank <= 20""",
    ),
    "stack_features": (
        stack_features,
        "WITH " + base.sql_records() + ", labelled AS (SELECT doc_id AS pmid, concat(title, ' ', chr(10), ' ', abstract) AS text "
        "FROM labels JOIN rec ON pmid = doc_id)," + _terms_cte("SELECT pmid, text FROM labelled")
        + " SELECT pmid, count(df) AS n_terms, CASE WHEN count(df) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS text_norm, "
        + ", ".join(f"CAST(any_value({c}) AS DOUBLE) AS {c}" for c in META_COLUMNS)
        + " FROM docs JOIN rec USING (pmid) LEFT JOIN counts USING (pmid) LEFT JOIN vocabulary USING (term) GROUP BY pmid",
    ),
    "logistic_optimum": (
        logistic_optimum,
        "WITH " + base.sql_records() + ", labelled AS (SELECT doc_id AS pmid, concat(title, ' ', chr(10), ' ', abstract) AS text "
        "FROM labels JOIN rec ON pmid = doc_id)," + _terms_cte("SELECT pmid, text FROM labelled")
        + f" SELECT (SELECT count(*) FROM docs) - CAST(ceil(0.25 * (SELECT count(*) FROM docs)) AS BIGINT) AS n_train, "
        f"count(*) + {len(META_COLUMNS)} AS n_features, true AS flat FROM vocabulary",
    ),
    "train_logistic": (train_logistic, None),
    "score_logistic": (score_logistic, linear_sql(_terms_cte, labelled_only=False)),
    "score_by_table": (score_by_table, linear_sql(_terms_cte, labelled_only=False)),
    "top_coefficients": (top_coefficients, coefficients_sql(_terms_cte)),
    "meta_coefficients": (meta_coefficients, meta_sql()),
    "save_model": (save_model, "SELECT *, true AS same FROM (" + linear_sql(_terms_cte, labelled_only=True) + ")"),
    "load_model": (load_model, coefficients_sql(_terms_cte)),
    "train_tree": (
        train_tree,
        sql_report(tree_ctes() + ", tested AS (SELECT * FROM predicted_rows WHERE is_test)", "tested"),
    ),
    "score_tree": (score_tree, tree_ctes() + " SELECT pmid, label, is_test, pred FROM predicted_rows"),
    "tree_rules": (tree_rules, tree_rules_sql()),
    "end_to_end_metrics": (end_to_end_metrics, None),
    "end_to_end_audit": (end_to_end_audit, None),
    "end_to_end_unlabeled": (end_to_end_unlabeled, None),
}
