import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sievework.functions.patterns import FLAG_COLUMNS
from sievework.functions.text import build_text
from sievework.operators import dual, features, models, newton
from sievework.plans import training
from sievework.sources import runs

WORDS = ["neural", "awareness", "coma", "report", "qualia", "patients", "method", "brain"]


def rows(spark, n=80):
    data = []
    for i in range(n):
        label = int(i % 4 == 0)
        words = [WORDS[(i * 3 + j * (1 + label)) % len(WORDS)] for j in range(6)]
        title = ("conscious " if label and i % 8 else "study ") + " ".join(words)
        data.append((i, title, "x" * (300 if i % 3 else 10), i % 2, label if i % 5 else 1, 0, i % 6, label))
    return spark.createDataFrame(
        data,
        "pmid bigint, title string, abstract string, has_mesh_consciousness_major int, has_mesh_consciousness int, "
        "has_mesh_spirit_religion int, n_mesh int, label int",
    )


@pytest.fixture(scope="module")
def trained(spark):
    df = rows(spark)
    features = models.stack_features(df)
    return df, models.train_logistic(features, df, max_iter=500, tol=1e-12)


def test_gradient_vanishes_at_the_optimum(trained):
    df, model = trained
    data = model.transform(df).select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r.x for r in data]), np.array([r.label for r in data])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w = model.stages[-1].coefficients.toArray()
    p = 1 / (1 + np.exp(-x @ w))
    gradient = x.T @ (weight * (p - y)) + w  # C = 1, intercept penalised as well
    assert np.linalg.norm(gradient) / len(y) < 1e-5
    assert (x[:, -1] == 1).all()


def test_text_block_has_length_one(trained):
    df, model = trained
    lengths = model.transform(df).select(vector_to_array("tfidf").alias("v")).collect()
    assert all(np.linalg.norm(r.v) == pytest.approx(1.0) for r in lengths)


def test_coefficients(trained):
    _, model = trained
    table = {r.feature: r.weight for r in models.coefficients(model).collect()}
    top = models.top_coefficients(model, 5).collect()
    assert [r.weight for r in top if r.side == "positive"] == sorted(table.values(), reverse=True)[:5]
    assert [r.weight for r in top if r.side == "negative"] == sorted(table.values())[:5]
    assert {r.feature for r in models.meta_coefficients(model).collect()} == {
        "__META_" + c for c in models.META_COLUMNS
    }
    assert "conscious" in table and table["conscious"] > 0


def test_scores_do_not_depend_on_partitions_and_survive_storage(spark, trained, tmp_path):
    df, model = trained
    scored = {r.pmid: r.model_prob for r in models.score_logistic(model, df.repartition(1)).collect()}
    assert {r.pmid: r.model_prob for r in models.score_logistic(model, df.repartition(7)).collect()} == scored
    runs.save_model(model, str(tmp_path / "m"))
    back = runs.load_model(str(tmp_path / "m"))
    assert {r.pmid: r.model_prob for r in models.score_logistic(back, df).collect()} == scored


def test_given_weights(spark, trained):
    df, model = trained
    features = type(model)(model.stages[:-1])
    table = models.coefficients(model, intercept=True)
    same = models.from_weights(features, table.unionByName(spark.createDataFrame([("no such term", 3.0)], table.schema)))
    assert np.array_equal(same.stages[-1].coefficients.toArray(), model.stages[-1].coefficients.toArray())
    few = models.from_weights(features, table.filter(F.col("feature") == "conscious"))
    assert np.count_nonzero(few.stages[-1].coefficients.toArray()) == 1


def test_scores_from_tables_are_those_of_the_model(spark, trained):
    df, model = trained
    vocabulary = features.fit_vocabulary(df.select(build_text().alias("text")), "text")
    more = df.unionByName(spark.createDataFrame([(999, "nothing known", "", 1, 0, 0, 3, 0), (998, None, None, None, 1, 0, 2, 0)], df.schema))
    scored = models.score_by_table(more, vocabulary, df.count(), models.coefficients(model, intercept=True))
    assert scored.columns == [*more.columns, "model_prob"]
    expected = {r.pmid: r.model_prob for r in models.score_logistic(model, more).collect()}
    assert {r.pmid: r.model_prob for r in scored.collect()} == pytest.approx(expected, abs=1e-9)


def test_vectors_as_rows(spark, trained):
    df, model = trained
    rows = models.vector_entries(model.transform(df)).groupBy("pmid").pivot("place").sum("value").fillna(0.0).collect()
    arrays = {r.pmid: r.x for r in model.transform(df).select("pmid", vector_to_array("features").alias("x")).collect()}
    assert len(rows) == len(arrays)
    for row in rows:
        found = {int(c): v for c, v in row.asDict().items() if c != "pmid"}
        assert [found.get(i, 0.0) for i in range(len(arrays[row.pmid]))] == arrays[row.pmid]


def problem(spark, n=400, width=300, seed=1):
    """Rows in which some features stand in nearly all rows and most in very few, with sizes from 0.01 to 10."""
    rng = np.random.default_rng(seed)
    share = np.where(np.arange(width) < 10, 0.9, 0.01)
    size = 10 ** rng.uniform(-2, 1, width)
    x = (rng.random((n, width)) < share) * size * rng.normal(1, 0.2, (n, width))
    side = np.where(rng.random(n) < 1 / (1 + np.exp(-x[:, :10] @ rng.normal(size=10) / 5)), 1.0, 0.0)
    weight = rng.uniform(0.5, 3, n)
    vectors = [(Vectors.sparse(width, np.flatnonzero(r).tolist(), r[r != 0].tolist()) if i % 2 else Vectors.dense(r), s, w)
               for i, (r, s, w) in enumerate(zip(x, side.tolist(), weight.tolist()))]
    return x, side, weight, spark.createDataFrame(vectors, ["features", "y", "w"]).repartition(3)


@pytest.mark.parametrize("driver_numbers", [newton.DRIVER_NUMBERS, 1])
def test_sums_over_blocks(spark, monkeypatch, driver_numbers):
    monkeypatch.setattr(newton, "DRIVER_NUMBERS", driver_numbers)
    monkeypatch.setattr(newton, "PIECE", 128)
    x, side, weight, rows = problem(spark)
    loss = newton.Loss(newton.blocks_of(rows, "features", "y", "w"), x.shape[1], 0.7)
    rng = np.random.default_rng(2)
    w, v = rng.normal(size=x.shape[1]) / 10, rng.normal(size=x.shape[1])
    p = 1 / (1 + np.exp(-x @ w))
    d = weight * p * (1 - p)
    value, gradient, diagonal = loss.at(w)
    assert value == pytest.approx(-(weight * (side * np.log(p) + (1 - side) * np.log(1 - p))).sum() + w @ w / 1.4)
    assert gradient == pytest.approx(x.T @ (weight * (p - side)) + w / 0.7)
    assert diagonal == pytest.approx((x * x).T @ d + 1 / 0.7)
    assert loss.hessian_times(w, v) == pytest.approx(x.T @ (d * (x @ v)) + v / 0.7)


def test_fit_is_within_its_tolerance_in_few_passes(spark):
    x, side, weight, rows = problem(spark)
    blocks = newton.blocks_of(rows, "features", "y", "w")
    exact = newton.minimise(newton.Loss(blocks, x.shape[1], 1.0), 100, 1e-12)
    p = 1 / (1 + np.exp(-x @ exact))
    assert np.linalg.norm(x.T @ (weight * (p - side)) + exact) < 1e-8
    loss = newton.Loss(blocks, x.shape[1], 1.0)
    assert np.linalg.norm(newton.minimise(loss, 100, 1e-4) - exact) <= 1e-4
    assert loss.passes < 120
    with pytest.raises(RuntimeError):
        newton.minimise(newton.Loss(blocks, x.shape[1], 1.0), 1, 1e-9)


def test_tree_limits(spark):
    df = training.flagged(rows(spark))
    tree = models.train_tree(df)
    fitted = tree.stages[-1]
    assert fitted.depth <= 3
    leaves = models.score_tree(tree, df).groupBy("pred").count().collect()
    assert all(r["count"] >= 10 for r in leaves)
    rules = [r.rule for r in models.tree_rules(tree).orderBy("line").collect()]
    assert any(name in rule for rule in rules for name in FLAG_COLUMNS)
    assert not any("feature " in rule for rule in rules)


def test_whole_run(spark, tmp_path):
    df = rows(spark, 120)
    labels = df.filter("pmid < 100").select("pmid", F.col("label").cast("string").alias("label"))
    run = training.train(labels, df.drop("label"), max_iter=50, sample_size=10)
    row = run.metrics.first()
    assert (row.n_train, row.n_test) == (75, 25) and row.tn + row.fp + row.fn + row.tp == 25
    audited = run.audit.collect()
    assert len(audited) == 100 and set(FLAG_COLUMNS) <= set(run.audit.columns)
    assert {r.pmid for r in run.unlabeled.collect()} <= set(range(100, 120)) and run.unlabeled.count() == 10
    assert run.report.count() == run.tree_report.count() == 5
    run.save(str(tmp_path / "run"))
    assert runs.read_metrics(spark, str(tmp_path / "run/metrics")).first() == row


@pytest.mark.parametrize("driver_numbers", [newton.DRIVER_NUMBERS, 1])
def test_fit_by_rows_finds_the_optimum_of_the_fit_by_features(spark, monkeypatch, driver_numbers):
    monkeypatch.setattr(newton, "DRIVER_NUMBERS", driver_numbers)
    monkeypatch.setattr(newton, "PIECE", 128)
    monkeypatch.setattr(dual, "ENTRIES", 1500)
    x, side, weight, rows = problem(spark, n=150, width=300)
    listed = rows.toArrow().num_rows
    numbered = models._with_numbers(rows, "_row").select("features", "y", "w", "_row")
    at = {r["_row"]: (r.y, r.w, r.features.toArray()) for r in numbered.collect()}
    assert sorted(at) == list(range(listed)) == list(range(150))
    y, w, x = (np.array([at[i][k] for i in range(150)]) for k in range(3))
    blocks = dual.column_blocks(numbered, "_row", "features")
    assert blocks.count() > 3
    kernel = dual.Kernel(blocks, 150)
    v = np.random.default_rng(3).normal(size=150)
    assert kernel.times(v) == pytest.approx(x @ (x.T @ v))
    a = dual.minimise(kernel, np.where(y > 0, 1.0, -1.0), w, np.ones((150, 1)), 0.7, 100, 1e-6)
    found = np.zeros(300)
    for r in kernel.coefficients(a).collect():
        found[r.place] = r.weight
    p = 1 / (1 + np.exp(-x @ found))
    assert 0.7 * np.linalg.norm(x.T @ (w * (p - y)) + found / 0.7) <= 1e-5
    with pytest.raises(RuntimeError):
        dual.minimise(dual.Kernel(blocks, 150), np.where(y > 0, 1.0, -1.0), w, np.ones((150, 1)), 0.7, 1, 1e-9)


def test_more_features_than_rows_need_no_vector_of_features_on_the_driver(spark, monkeypatch):
    df = rows(spark, 60)
    stacked = models.stack_features(df, min_df=2)
    assert stacked.terms.width > 40
    few = df.filter("pmid < 40")
    some = df.filter("pmid >= 40 and pmid < 44").withColumn("label", F.lit(None).cast("int"))
    lengths, real = [], newton.sum_over
    monkeypatch.setattr(dual, "sum_over", lambda table, part, length, tasks: lengths.append(length) or real(table, part, length, tasks))
    monkeypatch.setattr(newton, "sum_over", lambda table, part, length, tasks: lengths.append(length) or real(table, part, length, tasks))
    # Rows without a label are not learned from.
    learned = few.unionByName(some)
    model = models.train_logistic(stacked, learned, tol=1e-8)
    assert set(lengths) == {40}
    assert model.stages[-1].table.count() == stacked.terms.width
    assert models.loss_gradient(model, learned).agg(F.max(F.abs("slope"))).first()[0] < 1e-6


def test_fit_by_rows_learns_from_the_products_it_has_seen(spark, monkeypatch):
    class Local:
        def __init__(self, x):
            self.x, self.n, self.passes = x, len(x), 0

        def times(self, v):
            self.passes += 1
            return self.x @ (self.x.T @ v)

    rng = np.random.default_rng(4)
    topic = rng.random((6, 900)) ** 6
    x = topic[rng.integers(0, 6, 400)] * (rng.random((400, 900)) < 0.5) + 0.01 * rng.random((400, 900))
    x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((400, 1))])
    side = np.where(rng.random(400) < 0.4, 1.0, -1.0)
    passes = []
    for kept in (0, dual.KEPT_NUMBERS):
        monkeypatch.setattr(dual, "KEPT_NUMBERS", kept)
        kernel = Local(x)
        a = dual.minimise(kernel, side, np.ones(400), np.ones((400, 1)), 1.0, 100, 1e-6)
        p = 1 / (1 + np.exp(-x @ (x.T @ a)))
        assert np.linalg.norm(x.T @ (p - (side > 0)) + x.T @ a) <= 1e-5
        passes.append(kernel.passes)
    assert passes[1] < passes[0]


def test_columns_of_a_block_are_summed_from_where_they_start(spark):
    x, _, _, rows = problem(spark, n=60, width=40, seed=5)
    numbered = models._with_numbers(rows, "_row").select("features", "_row")
    x = np.array([r.features.toArray() for r in numbered.orderBy("_row").collect()])
    blocks = dual.column_blocks(numbered, "_row", "features")
    assert blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    found = np.zeros(40)
    for r in dual.Kernel(blocks, 60).coefficients(np.arange(60.0)).collect():
        found[r.place] = r.weight
    assert found == pytest.approx(x.T @ np.arange(60.0))
