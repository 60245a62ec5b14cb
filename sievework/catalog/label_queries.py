"""Registered queries: filters, joins, set operations, samples, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.catalog import base
from sievework.functions import scores
from sievework.operators import batching, labels as ops, sampling
from sievework.operators.sampling import BATCH_COLUMNS, SEED

_SEED = "WITH " + base.SQL_SEED
_REC = "WITH " + base.sql_records()
_REC_LAB = _REC + ", " + base.SQL_LABELS
_CLEAN = base.sql_label("label")
_BOTH = (
    "WITH " + base.SQL_SEED + ", " + base.SQL_REVIEWED + ", "
    f"both_sides AS (SELECT pmid, {_CLEAN} AS label, 0 AS src_prio FROM seed "
    f"UNION ALL SELECT pmid, {_CLEAN} AS label, 1 AS src_prio FROM reviewed)"
)
_MERGED = _BOTH + (
    ", merged AS (SELECT pmid, label FROM both_sides WHERE label IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY src_prio DESC) = 1)"
)


def _combined(spark, sf):
    return ops.union_labels(base.seed_labels(spark, sf), base.reviewed_labels(spark, sf))


def _records(spark, sf, *columns):
    rec = base.records(spark, sf)
    return rec.select(*columns) if columns else rec


def normalize_label(spark, sf):
    return base.seed_labels(spark, sf).select("pmid", scores.normalize_label("label").alias("label"))


def normalize_label_strict(spark, sf):
    return scores.normalize_label_strict(base.seed_labels(spark, sf)).select("pmid", "label")


def label_in_set(spark, sf):
    return ops.keep_known_labels(base.seed_labels(spark, sf)).select("pmid", "label")


def rejected_labels(spark, sf):
    return ops.rejected_labels(base.seed_labels(spark, sf))


def drop_unlabeled(spark, sf):
    joined = _records(spark, sf, "pmid", "title").join(base.labels(spark, sf), "pmid", "left")
    return ops.drop_unlabeled(joined)


def join_labels(spark, sf):
    rec = _records(spark, sf, "pmid", "title", "abstract", F.lit(9).alias("label"))
    return ops.join_labels(base.labels(spark, sf), rec)


def join_labels_unmatched(spark, sf):
    """Labels for keys that partly have no record."""
    shifted = base.labels(spark, sf).withColumn("pmid", F.col("pmid") * 2)
    return ops.join_labels(shifted, _records(spark, sf, "pmid", "title"))


def anti_join_labeled(spark, sf):
    return ops.anti_join_labeled(_records(spark, sf, "pmid", "title"), base.labels(spark, sf))


def attach_columns(spark, sf):
    rec = _records(spark, sf, "pmid", "title", "n_mesh")
    prob = _records(spark, sf, "pmid", base.tie_score("pmid").alias("model_prob"))
    return ops.attach_columns(base.labels(spark, sf), rec, prob)


def union_labels(spark, sf):
    return _combined(spark, sf).select("pmid", "label", "src_prio")


def duplicate_count(spark, sf):
    return ops.duplicate_count(_combined(spark, sf))


def dedup_keep_last(spark, sf):
    return ops.dedup_keep_last(_combined(spark, sf))


def sort_labels(spark, sf):
    return ops.sort_labels(ops.dedup_keep_last(_combined(spark, sf)))


def distinct_ids(spark, sf):
    ids = base.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pmid"))
    more = base.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pmid"))
    return ops.distinct_ids(ids.unionByName(more))


def union_buckets(spark, sf):
    return sampling.bucket_samples(_records(spark, sf)).select("pmid", "bucket")


def stratified_seed_batch(spark, sf):
    return sampling.stratified_seed_batch(_records(spark, sf))


def sample_n(spark, sf):
    return sampling.sample_n(_records(spark, sf, "pmid", "title", "abstract"))


def head_n(spark, sf):
    return sampling.head_n(_records(spark, sf, "pmid", "year"), 300)


def manual_review_sample(spark, sf):
    scored = base.scored_labels(spark, sf).drop("pred")
    return sampling.manual_review_sample(ops.join_labels(scored, _records(spark, sf, "pmid", "title", "abstract")))


def stratified_split(spark, sf):
    return sampling.stratified_split(base.labels(spark, sf))


def stratified_split_by_threshold(spark, sf):
    return sampling.stratified_split(base.labels(spark, sf), exact=False)


def range_bisect(spark, sf):
    """Orders by year, in ranges of at most 2000."""
    years = base.table(spark, sf, "orders").select(F.year("o_orderdate").alias("key"))
    return batching.range_bisect(batching.key_histogram(years, "key"), 1843, 2025, 2000)


def range_bisect_keys(spark, sf):
    """Line items by order key, in ranges of at most 9000."""
    keys = base.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    return batching.range_bisect(batching.key_histogram(keys, "key"), 0, 1_000_000)


def fixed_batches(spark, sf):
    ids = base.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pmid"))
    return batching.fixed_batches(ids)


def label_review_summary(spark, sf):
    merged = ops.dedup_keep_last(_combined(spark, sf))
    before = scores.normalize_label_strict(base.seed_labels(spark, sf))
    return ops.label_review_summary(base.scored_labels(spark, sf), before, merged)


_BUCKET = (
    "CASE WHEN has_mesh_consciousness_major = 1 THEN 'major' WHEN has_mesh_consciousness = 1 THEN 'any' ELSE 'none' END"
)
_SAMPLED = _REC + (
    f", sampled AS (SELECT *, {_BUCKET} AS bucket FROM rec QUALIFY row_number() OVER "
    f"(PARTITION BY bucket ORDER BY {base.sql_order('pmid', SEED)}, pmid) "
    "<= CASE bucket WHEN 'none' THEN 60 ELSE 120 END)"
)


def _first(key: str, n: int, seed: int = SEED) -> str:
    return f"ORDER BY {base.sql_order(key, seed)}, {key} LIMIT {n}"


# Test rows per class: whole parts of the class's share, then one more for the largest remainders.
_SPLIT = f"""
    WITH {base.SQL_LABELS},
    sizes AS (SELECT label, count(*) AS n_c FROM lab GROUP BY label),
    wanted AS (SELECT CAST(ceil(0.25 * count(*)) AS BIGINT) AS w, count(*) AS n FROM lab),
    parts AS (SELECT label, n_c, w, w * n_c // n AS whole, w * n_c % n AS rest FROM sizes, wanted),
    quotas AS (SELECT label, whole + CAST(row_number() OVER (ORDER BY rest DESC, n_c DESC, label)
                      <= w - sum(whole) OVER () AS INTEGER) AS quota FROM parts)
    SELECT pmid, label, row_number() OVER (PARTITION BY label ORDER BY {base.sql_order('pmid', SEED)}, pmid) <= quota AS is_test
    FROM lab JOIN quotas USING (label)"""


def _bisect_sql(keys: str, low: int, high: int, limit: int) -> str:
    return f"""
    WITH RECURSIVE hist AS (SELECT key, count(*) AS n FROM ({keys}) GROUP BY key),
    nodes AS (
      SELECT CAST({low} AS BIGINT) AS lo, CAST({high} AS BIGINT) AS hi,
             (SELECT CAST(sum(n) AS BIGINT) FROM hist WHERE key BETWEEN {low} AND {high}) AS n
      UNION ALL
      SELECT c.lo, c.hi, (SELECT CAST(sum(h.n) AS BIGINT) FROM hist h WHERE h.key BETWEEN c.lo AND c.hi) AS n
      FROM (SELECT lo, (lo + hi) // 2 AS hi FROM nodes WHERE n > {limit} AND lo < hi
            UNION ALL
            SELECT (lo + hi) // 2 + 1 AS lo, hi FROM nodes WHERE n > {limit} AND lo < hi) c)
    SELECT lo, hi, n, n > {limit} AS over_limit FROM nodes WHERE n > 0 AND (n <= {limit} OR lo = hi)"""


QUERIES = {
    "normalize_label": (normalize_label, _SEED + f" SELECT pmid, {_CLEAN} AS label FROM seed"),
    "normalize_label_strict": (
        normalize_label_strict,
        _SEED + f" SELECT * FROM (SELECT pmid, {_CLEAN} AS label FROM seed) WHERE label IS NOT NULL",
    ),
    "label_in_set": (label_in_set, _SEED + f" SELECT pmid, label FROM seed WHERE {_CLEAN} IS NOT NULL"),
    "rejected_labels": (
        rejected_labels,
        _SEED + f" SELECT label, count(*) AS n FROM seed WHERE {_CLEAN} IS NULL GROUP BY label",
    ),
    "drop_unlabeled": (drop_unlabeled, _REC_LAB + " SELECT pmid, title, label FROM rec JOIN lab USING (pmid)"),
    "join_labels": (
        join_labels,
        _REC_LAB + " SELECT pmid, label, title, abstract, CASE WHEN rec.pmid IS NOT NULL THEN 9 END AS label_all "
        "FROM lab LEFT JOIN rec USING (pmid)",
    ),
    "join_labels_unmatched": (
        join_labels_unmatched,
        _REC_LAB + " SELECT lab.pmid * 2 AS pmid, label, title FROM lab LEFT JOIN rec ON rec.pmid = lab.pmid * 2",
    ),
    "anti_join_labeled": (
        anti_join_labeled,
        _REC_LAB + " SELECT pmid, title FROM rec WHERE NOT EXISTS (SELECT 1 FROM lab WHERE lab.pmid = rec.pmid)",
    ),
    "exclude_labeled": (
        anti_join_labeled,
        _REC_LAB + " SELECT pmid, title FROM rec ANTI JOIN lab USING (pmid)",
    ),
    "attach_columns": (
        attach_columns,
        _REC_LAB + f" SELECT pmid, label, title, n_mesh, {base.sql_score('pmid')} AS model_prob FROM rec JOIN lab USING (pmid)",
    ),
    "union_labels": (union_labels, _BOTH + " SELECT pmid, label, src_prio FROM both_sides"),
    "duplicate_count": (
        duplicate_count,
        _BOTH + " SELECT count(*) - count(DISTINCT pmid) AS n_duplicates FROM both_sides",
    ),
    "dedup_keep_last": (dedup_keep_last, _MERGED + " SELECT pmid, label FROM merged"),
    "sort_labels": (sort_labels, _MERGED + " SELECT pmid, label FROM merged ORDER BY pmid"),
    "distinct_ids": (
        distinct_ids,
        "SELECT l_orderkey AS pmid FROM lineitem UNION SELECT o_orderkey AS pmid FROM orders",
    ),
    "union_buckets": (union_buckets, _SAMPLED + " SELECT pmid, bucket FROM sampled"),
    "stratified_seed_batch": (
        stratified_seed_batch,
        _SAMPLED + f" SELECT {', '.join(BATCH_COLUMNS)}, '' AS label FROM sampled {_first('pmid', 300, SEED + 1)}",
    ),
    "sample_n": (sample_n, _REC + f" SELECT pmid, title, abstract FROM rec {_first('pmid', 200)}"),
    "head_n": (head_n, _REC + f" SELECT pmid, year FROM rec {_first('pmid', 300, SEED + 1)}"),
    "manual_review_sample": (
        manual_review_sample,
        _REC + ", " + base.SQL_SCORED + " SELECT pmid, label, model_prob, title, abstract FROM scored LEFT JOIN rec USING (pmid) "
        + _first("pmid", 200),
    ),
    "stratified_split": (stratified_split, _SPLIT),
    "stratified_split_by_threshold": (
        stratified_split_by_threshold,
        f"SELECT doc_id AS pmid, quality AS label, substr({base.sql_order('doc_id', SEED)}, 1, 8) < '40000000' AS is_test FROM labels",
    ),
    "range_bisect": (
        range_bisect,
        _bisect_sql("SELECT year(o_orderdate) AS key FROM orders", 1843, 2025, 2000),
    ),
    "range_bisect_keys": (
        range_bisect_keys,
        _bisect_sql("SELECT l_orderkey AS key FROM lineitem", 0, 1_000_000, 9000),
    ),
    "fixed_batches": (
        fixed_batches,
        "SELECT pmid, CAST((row_number() OVER (ORDER BY pmid) - 1) // 8000 + 1 AS BIGINT) AS batch "
        "FROM (SELECT DISTINCT l_orderkey AS pmid FROM lineitem)",
    ),
    "label_review_summary": (
        label_review_summary,
        _MERGED + f", {base.SQL_SCORED}, joined AS (SELECT p.pred, b.label AS b, m.label AS a FROM scored p "
        f"JOIN (SELECT pmid, {_CLEAN} AS label FROM seed) b ON b.pmid = p.pmid AND b.label IS NOT NULL "
        "JOIN merged m ON m.pmid = p.pmid) "
        "SELECT count(*) AS n_reviewed, count(*) FILTER (pred = b) AS n_agree, count(*) FILTER (pred <> b) AS n_mismatch, "
        "count(*) FILTER (b <> a) AS n_corrected, count(*) FILTER (pred <> b AND b <> a) AS n_mismatch_corrected, "
        "count(*) FILTER (pred <> a) AS n_overridden FROM joined",
    ),
}
