import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.operators import batching, ranking, sampling


def md5(seed, key):
    return hashlib.md5(f"{seed}-{key}".encode()).hexdigest()


def records(spark, n, parts=3):
    """Most records are in one bucket."""
    major = (F.col("id") % 10 == 0).cast("int")
    df = spark.range(0, n, 1, parts).select(
        F.col("id").alias("pmid"),
        *(F.lit("x").alias(c) for c in ("year", "journal", "title", "abstract", "mesh_terms", "pub_types")),
        major.alias("has_mesh_consciousness_major"),
        F.when(F.col("id") % 50 == 1, 1).otherwise(major).alias("has_mesh_consciousness"),
        F.lit(0).alias("has_mesh_spirit_religion"),
        F.lit(1).alias("n_mesh"),
    )
    return df


def test_seed_batch_takes_the_first_of_each_bucket(spark):
    df = records(spark, 3000)
    rows = sampling.bucket_samples(df).collect()
    assert Counter(r.bucket for r in rows) == {"major": 120, "any": 60, "none": 60}
    none = sorted((i for i in range(3000) if i % 10 and i % 50 != 1), key=lambda i: md5(1073, i))[:60]
    assert {r.pmid for r in rows if r.bucket == "none"} == set(none)
    batch = sampling.stratified_seed_batch(df).collect()
    assert len(batch) == 240 and batch[0].label == ""
    assert [r.pmid for r in batch] == [r.pmid for r in sorted(batch, key=lambda r: md5(1074, r.pmid))]


@pytest.mark.parametrize("parts", [1, 7])
def test_samples_do_not_depend_on_partitions(spark, parts):
    got = {r.pmid for r in sampling.sample_n(records(spark, 1000, parts).select("pmid"), 200).collect()}
    assert got == set(sorted(range(1000), key=lambda i: md5(1073, i))[:200])


def test_sample_of_few_rows_and_of_repeated_keys(spark):
    assert sampling.sample_n(spark.range(5).withColumnRenamed("id", "pmid"), 200).count() == 5
    repeated = spark.range(1000).select(F.lit(1).alias("pmid"))
    assert sampling.sample_n(repeated, 200).count() == 200
    without_key = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("pmid"))
    assert sampling.sample_n(without_key, 200).count() == 200


@pytest.mark.parametrize("n", [400, 2500])
def test_a_key_of_a_third_of_the_rows_at_the_cutoff(spark, n):
    """Rows without a key, of which some are copies, stand where the sample ends."""
    for seed in range(200):
        first = sum(md5(seed, i) < md5(seed, "") for i in range(6000) if i % 3)
        if 0 < n - first < 2000:
            break
    df = spark.range(0, 6000, 1, 7).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("pmid"), F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.col("id") % 900).alias("other")
    )
    rows = sampling.sample_n(df, n, seed).collect()
    assert len(rows) == n
    assert {r.pmid for r in rows if r.pmid is not None} == {i for i in range(6000) if i % 3 and md5(seed, i) < md5(seed, "")}
    again = sampling.sample_n(df.repartition(3), n, seed).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    available = Counter((None, i % 900) for i in range(0, 6000, 3))
    assert all(available[k] >= c for k, c in Counter(map(tuple, rows)).items() if k[0] is None)


def test_repeated_keys_in_buckets(spark):
    df = records(spark, 3000).withColumn("pmid", F.col("pmid") % 40)
    rows = sampling.bucket_samples(df, {"none": 50, "major": 7, "any": 100}).collect()
    assert Counter(r.bucket for r in rows) == {"none": 50, "major": 7, "any": 60}
    for bucket, wanted in (("none", 50), ("major", 7)):
        ids = [i for i in range(3000) if bucket == ("major" if i % 10 == 0 else "any" if i % 50 == 1 else "none")]
        order = sorted((md5(1073, i % 40) for i in ids))[:wanted]
        assert sorted(md5(1073, r.pmid) for r in rows if r.bucket == bucket) == order


@pytest.mark.parametrize("n", [5, 3000])
def test_a_sample_scans_its_table_twice(spark, tmp_path, n):
    path = str(tmp_path / "rows")
    spark.range(0, 5000, 1, 4).select(F.col("id").alias("pmid"), F.lit("w").alias("title")).write.parquet(path)
    plan = sampling.sample_n(spark.read.parquet(path), n)._jdf.queryExecution().executedPlan().toString()
    # The cut-off is known by then: the plan that gives the rows has one scan and no join.
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_split_of_the_labelled_set(spark):
    df = spark.range(500).select(F.col("id").alias("pmid"), (F.col("id") < 102).cast("int").alias("label"))
    counts = Counter((r.label, r.is_test) for r in sampling.stratified_split(df).collect())
    assert counts == {(1, True): 25, (0, True): 100, (1, False): 77, (0, False): 298}
    one = {r.pmid for r in sampling.stratified_split(df.repartition(1)).filter("is_test").collect()}
    seven = {r.pmid for r in sampling.stratified_split(df.repartition(7)).filter("is_test").collect()}
    positives = sorted(range(102), key=lambda i: md5(1073, i))[:25]
    assert one == seven and {i for i in one if i < 102} == set(positives)


def test_threshold_split_is_close_to_the_share(spark):
    df = spark.range(20000).select(F.col("id").alias("pmid"), F.lit(1).alias("label"))
    share = sampling.stratified_split(df, exact=False).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert abs(share - 0.25) < 0.02


@pytest.mark.parametrize("rows_per_range, descending", [(10, False), (10, True), (10**6, True)])
def test_running_totals(spark, rows_per_range, descending):
    values = list({i * i % 1009 + i / 7.0: i % 5 for i in range(500)}.items())
    df = spark.createDataFrame(values, "score double, n bigint").repartition(7)
    got = {r.score: r.total for r in ranking.running_totals(df, "score", {"total": "n"}, descending, rows_per_range).collect()}
    total = 0
    for score, n in sorted(values, reverse=descending):
        total += n
        assert got[score] == total


LEAVES = [
    (1843, 1934, 29), (1935, 1980, 3854), (1981, 1992, 5897), (1993, 1998, 4327), (1999, 2003, 4773),
    (2004, 2009, 7923), (2010, 2012, 5271), (2013, 2014, 4391), (2015, 2017, 6765), (2018, 2020, 7974),
    (2021, 2022, 6974), (2023, 2023, 3829), (2024, 2025, 6618),
]


@pytest.mark.parametrize("levels", [1, 3, 20])
def test_bisect_of_the_logged_run(spark, levels):
    histogram = spark.createDataFrame([(lo, n) for lo, _, n in LEAVES], "key int, n bigint")
    rows = batching.range_bisect(histogram, 1843, 2025, levels=levels).orderBy("lo").collect()
    assert [(r.lo, r.hi, r.n) for r in rows] == LEAVES
    assert not any(r.over_limit for r in rows)


def test_bisect_marks_a_single_value_over_the_limit(spark):
    histogram = spark.createDataFrame([(3, 50), (4, 5), (-7, 2)], "key int, n bigint")
    rows = batching.range_bisect(histogram, -8, 8, limit=10, levels=2).orderBy("lo").collect()

    def brute(lo, hi):
        n = sum(c for k, c in ((3, 50), (4, 5), (-7, 2)) if lo <= k <= hi)
        if n == 0:
            return []
        if n <= 10 or lo == hi:
            return [(lo, hi, n, n > 10)]
        return brute(lo, (lo + hi) // 2) + brute((lo + hi) // 2 + 1, hi)

    assert [tuple(r) for r in rows] == brute(-8, 8)


def test_fixed_batches(spark):
    ids = spark.range(65832).select((F.col("id") * 3).alias("pmid"))
    rows = batching.fixed_batches(ids.union(ids.limit(10)), rows_per_range=5000).groupBy("batch").agg(
        F.count("*").alias("n"), F.min("pmid").alias("lo"), F.max("pmid").alias("hi")
    ).orderBy("batch").collect()
    assert [r.n for r in rows] == [8000] * 8 + [1832]
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
