"""The relevance classifier and the small rule tree."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sievework.functions.patterns import FLAG_COLUMNS
from sievework.functions.scores import META_COLUMNS
from sievework.functions.text import build_text
from sievework.operators import blocks, dual, newton
from sievework.operators.features import MAX_DF, MIN_DF, vocabulary_of, words_of
from sievework.operators.metrics import with_class_weight
from sievework.session import scratch_path, stored

META_PREFIX = "__META_"
INTERCEPT = "__INTERCEPT__"
# File of a stored model with its numbers.
ABOUT = "about"
ROWS_PER_TASK = 20_000

# Steps of the optimiser, depth and leaf size of the tree, features listed.
MAX_ITER = 5000
# Distance of the coefficients from the optimum.
TOLERANCE = 1e-5
TREE_DEPTH = 3
TREE_LEAF = 10
TOP_K = 20


class Terms:
    """Vocabulary with places in the vector, kept as a table (term, place, df), and the meta columns behind it.

    ``fitted_on`` are the rows it was fitted on and the stored table of their counted terms.
    """

    def __init__(self, table: DataFrame, n_docs: int, meta_columns: Sequence[str], fitted_on: tuple[DataFrame, DataFrame] | None = None):
        self.table, self.n_docs, self.meta_columns, self.fitted_on = table, n_docs, tuple(meta_columns), fitted_on

    @cached_property
    def n_terms(self) -> int:
        return self.table.count()

    def counted(self, df: DataFrame, keep: Sequence[str], held_out: str | None) -> tuple[DataFrame, Column | None]:
        """Counted terms of ``df`` by blocks, with the columns ``keep`` and ``_meta``, and a condition for the rows that count.

        Those of the very table that the vocabulary was fitted on are there already.
        """
        if self.fitted_on is not None and df is self.fitted_on[0]:
            rows, row = self.fitted_on[1], F.col("row")
            if {*keep, held_out} <= {None, *rows.schema["row"].dataType.names}:
                inside = F.lit(True) if held_out is None else ~row.getField(held_out)
                return rows.withColumns({"_in": inside, "row": F.struct(*(row.getField(c).alias(c) for c in [*keep, "_meta"]))}), F.col("_in")
        df = df if held_out is None else df.filter(~F.col(held_out))
        return counted_rows(df, keep, self.meta_columns), None

    @cached_property
    def _fitted_hits(self) -> DataFrame:
        return stored(blocks.known_terms(self.fitted_on[1], self.table, ["place", "df"]))

    def hits(self, rows: DataFrame, fitted: bool) -> DataFrame:
        """Places of the blocks' terms. Those of the rows that the vocabulary was fitted on are looked up once."""
        return self._fitted_hits if fitted else blocks.known_terms(rows, self.table, ["place", "df"])

    @property
    def width(self) -> int:
        """Terms, meta columns and the constant."""
        return self.n_terms + len(self.meta_columns) + 1

    def names(self) -> DataFrame:
        """Rows (feature, place), the intercept's included."""
        others = [*(META_PREFIX + c for c in self.meta_columns), INTERCEPT]
        rows = [(name, self.n_terms + i) for i, name in enumerate(others)]
        return self.table.select(F.col("term").alias("feature"), "place").unionByName(
            self.table.sparkSession.createDataFrame(rows, "feature string, place bigint")
        )


class Weights:
    """Coefficients as a table (place, weight); the last one is the weight of the constant feature."""

    def __init__(self, table: DataFrame, width: int):
        self.table, self.width = table, width

    @property
    def coefficients(self) -> DenseVector:
        """All of them, on the driver."""
        found = self.table.toArrow()
        values = np.zeros(self.width)
        values[found["place"].to_numpy()] = found["weight"].to_numpy()
        return DenseVector(values)


class TermModel:
    """Features of records, and their classifier where there are weights. What grows with the vocabulary is in tables."""

    def __init__(self, stages: Sequence[Terms | Weights]):
        self.stages = list(stages)

    @property
    def terms(self) -> Terms:
        return self.stages[0]

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Add ``tfidf`` and ``features`` to the columns ``keep`` (all); with weights, ``probability`` as well."""
        added = ["tfidf", "features", *(["probability"] if len(self.stages) > 1 else [])]
        return self.computed(df, df.columns if keep is None else keep, {name: name for name in added})

    def computed(self, df: DataFrame, keep: Sequence[str], added: dict[str, str], held_out: str | None = None) -> DataFrame:
        """The columns ``keep`` and some of ``tfidf``, ``features`` and ``probability``, under the names they are mapped to.

        Terms of a record meet the vocabulary by blocks of records, whose rows are stored; sums are in the order of places.
        Rows for which the column ``held_out`` is true are left out.
        """
        n_terms, width, n_docs, n_meta = self.terms.n_terms, self.terms.width, self.terms.n_docs, len(self.terms.meta_columns)
        rows, inside = self.terms.counted(df, keep, held_out)
        hits, fixed = self.terms.hits(rows, inside is not None), None
        if "probability" in added:
            weights = self.stages[1].table
            behind = weights.filter(F.col("place") >= n_terms).toArrow()
            fixed = np.zeros(n_meta + 1)
            fixed[behind["place"].to_numpy() - n_terms] = behind["weight"].to_numpy()
            hits = hits.join(weights, "place")
        kinds = {"tfidf": VectorUDT(), "features": VectorUDT(), "probability": DoubleType()}
        kept = rows.schema["row"].dataType.fields[:-1]
        schema = StructType([*kept, *(StructField(out, kinds[name]) for name, out in added.items())])

        def run(row, n, docs, places, tf, hits):
            raw = tf * (np.log((1.0 + n_docs) / (1.0 + hits.column("df").to_numpy())) + 1.0)[places]
            value = raw / np.sqrt(blocks.sums(docs, raw * raw, n))[docs]
            at = hits.column("place").to_numpy()[places]
            others = np.asarray(row.field(len(kept)).flatten()).reshape(n, n_meta)
            out = {}
            if "tfidf" in added:
                out["tfidf"] = _vectors(n, n_terms, docs, at, value)
            if "features" in added:
                constant = np.column_stack([others, np.ones(n)])
                doc, place = np.nonzero(constant)
                order = np.argsort(np.concatenate([docs, doc]), kind="stable")
                joined = (np.concatenate(pair)[order] for pair in ((docs, doc), (at, place + n_terms), (value, constant[doc, place])))
                out["features"] = _vectors(n, width, *joined)
            if "probability" in added:
                margin = blocks.sums(docs, value * hits.column("weight").to_numpy()[places], n)
                for i in range(n_meta):
                    margin = margin + others[:, i] * fixed[i]
                out["probability"] = pa.array(newton.sigmoid(margin + fixed[-1]))
            return pa.table([*(row.field(i) for i in range(len(kept))), *(out[name] for name in added)], [*(f.name for f in kept), *added.values()])

        return blocks.with_known_terms(rows, hits, "place", run, schema, inside)

    def save(self, path: str) -> None:
        """Tables and numbers below ``path``; what is there is replaced."""
        about = {"n_docs": self.terms.n_docs, "meta_columns": self.terms.meta_columns, "width": self.terms.width, "fitted": len(self.stages) > 1}
        spark = self.terms.table.sparkSession
        # Stored first: the model may have been read from the very path that is replaced.
        tables = {"terms": stored(self.terms.table)} | ({"weights": stored(self.stages[1].table)} if len(self.stages) > 1 else {})
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        spark.createDataFrame([(json.dumps(about),)], "value string").write.mode("overwrite").text(f"{path}/{ABOUT}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermModel:
        about = json.loads(spark.read.text(f"{path}/{ABOUT}").first().value)
        terms = Terms(spark.read.parquet(f"{path}/terms"), about["n_docs"], about["meta_columns"])
        return cls([terms, Weights(spark.read.parquet(f"{path}/weights"), about["width"])] if about["fitted"] else [terms])


def counted_rows(df: DataFrame, keep: Sequence[str], meta_columns: Sequence[str], totals: bool = False) -> DataFrame:
    """Stored table of the counted terms of ``df`` by blocks, with the columns ``keep`` and ``_meta``, the meta columns as numbers."""
    meta = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in meta_columns)).cast("array<double>")
    source = df.select(*keep, meta.alias("_meta"), build_text().alias("_text"))
    return blocks.block_rows(source, words_of("_text"), [*keep, "_meta"], totals=totals)


def _vectors(n: int, size: int, docs: np.ndarray, places: np.ndarray, values: np.ndarray) -> pa.StructArray:
    """Sparse vectors of ``n`` rows; entries are sorted by row and place."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=n))]), pa.int32())

    def lists(numbers, kind):
        of = pa.field("element", kind, nullable=False)
        return pa.ListArray.from_arrays(offsets, pa.array(numbers, kind), type=pa.list_(of)), pa.list_(of)

    (indices, places_type), (entries, values_type) = lists(places, pa.int32()), lists(values, pa.float64())
    fields = [pa.field("type", pa.int8(), nullable=False), pa.field("size", pa.int32()), pa.field("indices", places_type), pa.field("values", values_type)]
    parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), indices, entries]
    return pa.StructArray.from_arrays(parts, fields=fields)


def _with_numbers(rows: DataFrame, name: str) -> DataFrame:
    """Stored rows with their number from 0, in the order they have. They are numbered within their parts."""
    parts = stored(rows.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = F.col("_id") - F.shiftleft("_part", 33)
    # One row per part of a stored table.
    numbered = parts.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + within)
    return numbered.drop("_id", "_part", "_n", "_start")


def _numbered(vocabulary: DataFrame) -> DataFrame:
    """Stored vocabulary with ``place``: the most frequent term first, then by name. Rows are numbered within sorted parts."""
    return stored(_with_numbers(vocabulary.orderBy(F.desc("df"), "term"), "place").select("term", "place", "df"))


def stack_features(
    labelled: DataFrame,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    max_features: int | None = None,
    meta_columns: Sequence[str] = META_COLUMNS,
    keep: Sequence[str] | None = None,
) -> TermModel:
    """Fit the features on labelled rows with title, abstract and meta columns.

    The terms of these rows are counted once: the counts, with the columns ``keep`` (all), serve whatever the model
    computes later of the same table. What asks for other columns has the terms counted again.

    The model adds ``features``: TF-IDF of words and bigrams, the meta columns, and
    a constant for the intercept. All terms within the document frequencies are kept unless ``max_features``
    is given; they are a table, which neither the driver nor a task holds whole. Their order, the most
    frequent first and then by name, doesn't depend on how the rows are partitioned.
    """
    rows, n_docs = counted_rows(labelled, labelled.columns if keep is None else keep, meta_columns, totals=True), labelled.count()
    vocabulary = vocabulary_of(blocks.totals_of(rows), n_docs, min_df, max_df, max_features)
    terms = Terms(_numbered(vocabulary), n_docs, meta_columns, (labelled, rows))
    if not terms.n_terms:
        raise ValueError("no term is in enough of the labelled texts")
    return TermModel([terms])


def vector_entries(df: DataFrame, key: str = "pmid", vector: str = "features") -> DataFrame:
    """The values of a vector column as rows (key, place, value), zeros of sparse vectors left out."""
    parts = F.unwrap_udt(vector)
    places = F.when(parts["type"] == 0, parts["indices"]).otherwise(F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    return df.select(key, F.inline(F.arrays_zip(places.alias("place"), parts["values"].alias("value"))))


def feature_names(features: TermModel) -> list[str]:
    """Names in coefficient order, on the driver: terms, then meta columns with their prefix."""
    return features.terms.names().orderBy("place").toArrow()["feature"].to_pylist()[:-1]


def from_weights(features: TermModel, weights: DataFrame) -> TermModel:
    """A classifier whose weights are given as rows (feature, weight), as :func:`coefficients` returns them.

    The intercept is the row named ``INTERCEPT``; a feature without a row weighs 0, and a row without a feature is left out.
    Of several weights of a feature the largest counts.
    """
    given = weights.groupBy("feature").agg(F.max(F.col("weight").cast("double")).alias("weight"))
    table = features.terms.names().join(given, "feature", "left").select("place", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    return TermModel([features.terms, Weights(stored(table), features.terms.width)])


def train_logistic(
    features: TermModel,
    train: DataFrame,
    label: str = "label",
    c: float = 1.0,
    max_iter: int = MAX_ITER,
    tol: float = TOLERANCE,
    held_out: str | None = None,
) -> TermModel:
    """L2 logistic regression with balanced class weights and a penalised intercept, the weight of the constant feature.

    Rows for which the column ``held_out`` is true are not learned from.

    The fit ends when the coefficients are within ``tol`` of the optimum (Euclidean distance); one that
    doesn't get there in ``max_iter`` Newton steps is an error. The driver's vectors have a number per feature or
    per training row, whichever are fewer.
    """
    width, meta = features.terms.width, features.terms.meta_columns
    learned = train if held_out is None else train.filter(~F.col(held_out))
    n = learned.count()
    stacked = TermModel([features.terms]).computed(train, list(dict.fromkeys([label, *meta])), {"features": "features"}, held_out)
    others = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in meta), F.lit(1.0))
    # Labels are counted in the rows as they came: counted behind their features, these would be made twice.
    rows = with_class_weight(stacked, label, "_weight", learned).select(
        "features", F.col(label).cast("double").alias("_y"), "_weight", others.alias("_others")
    )
    if width > n:
        return TermModel([features.terms, _fit_by_rows(features.terms, rows, c, max_iter, tol)])
    # Every step is one job, so a small training set goes into few tasks.
    rows = rows.repartition(math.ceil((n + 1) / ROWS_PER_TASK))
    path = scratch_path(train.sparkSession, "training")
    rows.drop("_others").write.parquet(path)
    cut = newton.blocks_of(train.sparkSession.read.parquet(path), "features", "_y", "_weight")
    weights = newton.minimise(newton.Loss(cut, width, c), max_iter, tol)
    starts = range(0, width, newton.PIECE)
    pieces = pa.table({"start": pa.array(starts, pa.int64()), "piece": [weights[i : i + newton.PIECE] for i in starts]})
    listed = train.sparkSession.createDataFrame(pieces).select("start", F.posexplode("piece").alias("_at", "weight"))
    table = stored(listed.select((F.col("start") + F.col("_at")).alias("place"), "weight"))
    return TermModel([features.terms, Weights(table, width)])


def _fit_by_rows(terms: Terms, rows: DataFrame, c: float, max_iter: int, tol: float) -> Weights:
    """Weights of a fit whose vectors have a number per row, for more features than rows."""
    numbered = _with_numbers(rows, "_row")
    found = numbered.select("_row", F.when(F.col("_y") > 0, 1.0).otherwise(-1.0).alias("_side"), "_weight", "_others").orderBy("_row").toArrow()
    # Rows without a label are not among them.
    n = found.num_rows
    side, weight = (found[name].to_numpy() for name in ("_side", "_weight"))
    common = blocks._column(found, "_others").flatten().to_numpy().reshape(n, len(terms.meta_columns) + 1)
    kernel = dual.Kernel(dual.column_blocks(numbered, "_row", "features"), n)
    fitted = kernel.coefficients(dual.minimise(kernel, side, weight, common, c, max_iter, tol))
    # A feature that no row has weighs nothing.
    weights = terms.names().select("place").join(fitted, "place", "left").select("place", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    return Weights(stored(weights), terms.width)


def loss_gradient(model: TermModel, train: DataFrame, label: str = "label", c: float = 1.0, held_out: str | None = None) -> DataFrame:
    """Gradient (place, slope) of the penalised, class-weighted loss at the model's coefficients; near 0 everywhere at the optimum."""
    learned = train if held_out is None else train.filter(~F.col(held_out))
    computed = model.computed(train, [label], {"features": "features", "probability": "_p"}, held_out)
    scored = with_class_weight(computed, label, "_weight", learned)
    gaps = scored.select("features", (F.col("_weight") * (F.col("_p") - F.col(label))).alias("_gap"))
    sums = vector_entries(gaps, "_gap").groupBy("place").agg(F.sum(F.col("value") * F.col("_gap")).alias("_sum"))
    return model.stages[-1].table.join(sums, "place", "left").select(
        "place", (F.coalesce("_sum", F.lit(0.0)) + F.col("weight") / c).alias("slope")
    )


def score_logistic(model: TermModel, df: DataFrame, out: str = "model_prob", keep: Sequence[str] | None = None) -> DataFrame:
    """Add the probability of class 1 to the columns ``keep`` (all)."""
    keep = df.columns if keep is None else keep
    return model.computed(df, [c for c in keep if c != out], {"probability": out})


def score_by_table(
    records: DataFrame,
    vocabulary: DataFrame,
    n_docs: int,
    weights: DataFrame,
    out: str = "model_prob",
    key: str = "pmid",
    meta_columns: Sequence[str] = META_COLUMNS,
) -> DataFrame:
    """Add the probability of class 1 by joins: no driver or task holds the vocabulary or the weights.

    ``vocabulary`` has the terms and document frequencies (term, df) of ``n_docs`` documents, ``weights`` is as for
    :func:`from_weights`. ``key`` is distinct. Terms meet the records by blocks of these.
    """
    known = stored(
        vocabulary.join(weights.select(F.col("feature").alias("term"), "weight"), "term", "left")
        .select("term", F.xxhash64("term").alias("_order"), (F.ln(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("_idf"), F.coalesce("weight", F.lit(0.0)).alias("_weight"))
    )
    rows = blocks.block_rows(records.select(key, build_text().alias("_text")), words_of("_text"), [key])
    schema = StructType([*rows.schema["row"].dataType.fields, StructField("_sum", DoubleType()), StructField("_square", DoubleType())])

    def run(row, n, docs, places, tf, hits):
        raw = tf * hits.column("_idf").to_numpy()[places]
        parts = (blocks.sums(docs, raw * weight, n) for weight in (hits.column("_weight").to_numpy()[places], raw))
        return pa.table([row.field(0), *map(pa.array, parts)], [key, "_sum", "_square"])

    hits = blocks.known_terms(rows, known, ["_order", "_idf", "_weight"])
    sums = blocks.with_known_terms(rows, hits, "_order", run, schema).filter(F.col("_square") > 0)
    parts = sums.groupBy(key).agg((F.sum("_sum") / F.sqrt(F.sum("_square"))).alias("_margin"))

    def weight_of(feature: str) -> Column:
        return F.coalesce(weights.filter(F.col("feature") == feature).agg(F.max("weight")).scalar(), F.lit(0.0))

    margin = F.coalesce("_margin", F.lit(0.0)) + weight_of(INTERCEPT)
    for column in meta_columns:
        margin = margin + F.coalesce(F.col(column).cast("double"), F.lit(0.0)) * weight_of(META_PREFIX + column)
    scored = records.join(parts, key, "left").withColumn(out, 1 / (1 + F.exp(-margin)))
    return scored.select(*records.columns, out)


def coefficients(model: TermModel, intercept: bool = False) -> DataFrame:
    """Rows (feature, weight), with or without the intercept."""
    terms, weights = model.terms, model.stages[-1]
    if weights.width != terms.width:
        raise ValueError(f"{weights.width} weights for {terms.width - 1} features and the intercept")
    table = terms.names().join(weights.table, "place").select("feature", "weight")
    return table if intercept else table.filter(F.col("feature") != INTERCEPT)


def top_coefficients(model: TermModel, k: int = TOP_K) -> DataFrame:
    """The ``k`` largest and ``k`` smallest weights; ties in name order."""
    table = coefficients(model)

    def ranked(side: str, order) -> DataFrame:
        return table.orderBy(order, "feature").limit(k).withColumn("side", F.lit(side))

    return ranked("positive", F.desc("weight")).unionByName(ranked("negative", F.asc("weight")))


def meta_coefficients(model: TermModel) -> DataFrame:
    return coefficients(model).filter(F.col("feature").startswith(META_PREFIX))


def train_tree(
    train: DataFrame,
    flags: Sequence[str] = FLAG_COLUMNS,
    label: str = "label",
    depth: int = TREE_DEPTH,
    leaf: int = TREE_LEAF,
    seed: int = 1073,
) -> PipelineModel:
    """A small tree over 0/1 flags with balanced class weights."""
    stack = VectorAssembler(inputCols=list(flags), outputCol="_flags")
    rows = with_class_weight(stack.transform(train), label, "_weight").select(
        "_flags", F.col(label).cast("double").alias("_y"), "_weight"
    )
    fitted = DecisionTreeClassifier(
        featuresCol="_flags",
        labelCol="_y",
        weightCol="_weight",
        predictionCol="_tree_pred",
        rawPredictionCol="_tree_raw",
        probabilityCol="_tree_probability",
        maxDepth=depth,
        minInstancesPerNode=leaf,
        impurity="gini",
        seed=seed,
    ).fit(rows)
    return PipelineModel([stack, fitted])


def score_tree(model: PipelineModel, df: DataFrame, out: str = "pred") -> DataFrame:
    return model.transform(df).select(*df.columns, F.col("_tree_pred").cast("int").alias(out))


def tree_rules(model: PipelineModel) -> DataFrame:
    """The tree as numbered lines of text, with the names of the flags."""
    stack, tree = model.stages
    names = stack.getInputCols()
    text = re.sub(r"\bfeature (\d+)\b", lambda m: names[int(m.group(1))], tree.toDebugString)
    lines = [(i, line) for i, line in enumerate(text.rstrip().splitlines()[1:], 1)]
    return SparkSession.getActiveSession().createDataFrame(lines, "line int, rule string")
