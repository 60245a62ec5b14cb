"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Everything is column expressions; there is no Python code on the executors.

* Sizes are words per document. They are counted once: rows are stored with size and draw, and with the text only where it
  is given out. A filter on computed columns would count the words again, several times a row.
* Each row draws ``-ln(u) / weight`` from a hash of its key, where ``weight`` is a quality weight.
  Rows with the smallest draws come first. A source's target is met by as many complete epochs
  as fit, then by rows in that order until the budget ends; the row at the edge gives only the
  words that are left, so each source meets its target to the word.
* The order within a source is never sorted in one place: draws are cut into coarse slices, which are summed; the slices of
  the one in which a budget ends are summed too, and only the slice in which the budget ends is sorted: at most about four
  millionths of a source.

A null text has size 0; a null source is a source of its own, the last one. Rows draw by key, so rows that share a key
share their draw and follow each other in order of a hash of their texts; where a budget ends among them, they are sorted
together. Columns other than key, text and source are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
# Coarse slices of draws, each of 1 / STEPS, and the slices that each is cut into. Less than one draw in a million is beyond the last.
COARSE, STEPS, PARTS = 4096, 64, 4096


def quality_weight(text: Column | str, words: Column) -> Column:
    """1 for a text whose words have 3 to 10 characters on average, falling to 0.25 as they get longer or shorter."""
    text = F.col(text) if isinstance(text, str) else text
    mean = F.when(words > 0, F.length(text) / words - 1).otherwise(0.0)
    return F.greatest(F.lit(0.25), F.when(mean < 3, mean / 3).when(mean > 10, 10 / mean).otherwise(1.0))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``_size``, ``_draw``, its ``_slice``, and ``_tie``, a hash of the text."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    # 52 bits of the hash as a number in (0, 1).
    digest = F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    draw = -F.ln(uniform) / F.coalesce(quality_weight(text, words), F.lit(0.25))
    drawn = docs.withColumns({"_size": words, "_draw": draw, "_tie": F.xxhash64(text)})
    number = F.floor(F.least(F.col("_draw") * STEPS, F.lit(COARSE - 1.0)) * PARTS)
    return drawn.withColumn("_slice", number.cast("bigint"))


def source_targets(sums: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``_source``, ``source_size``, ``target``; ``sums`` has parts of sources and their words ``_n``.

    Sources in order of their names (null last) have the weights in turn and share the total by
    weight. A target stops at ``most`` times its source's size and what is over goes to the
    others by weight, until none is above. In order of size per weight, the first sources are the
    capped ones, and a running sum tells where they end. The table has a row per source.
    """
    per_source = sums.groupBy("_source").agg(F.sum("_n").alias("source_size"))
    everything = Window.partitionBy().orderBy(F.col("_source").asc_nulls_last())
    number = F.row_number().over(everything) - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(number, F.lit(len(weights))).cast("int"))
    table = per_source.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(most))

    whole = Window.partitionBy()
    upto = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    open_weight = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    table = table.withColumn("_level", left / open_weight)
    # The level of the first source that stays below its cap; it holds for all that follow.
    is_open = F.col("_cap") > F.col("_level") * F.col("_weight")
    first_open = F.min(F.when(is_open, F.struct(F.col("_cap") / F.col("_weight"), F.col("_level")))).over(whole)
    target = F.least(F.col("_cap"), F.coalesce(first_open["_level"] * F.col("_weight"), F.col("_cap")))
    return table.select("_source", "source_size", target.alias("target"))


def _where_it_ends(sums: DataFrame, budgets: DataFrame, place: str, cut: str, left: str) -> DataFrame:
    """``budgets`` (``_in``, ``_budget``) with the first ``place`` that exceeds the budget (null: none does) and what is ``left`` for it."""
    upto = Window.partitionBy("_source").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sums.withColumn("_upto", F.sum("_n").over(upto))
    over = ends.join(budgets.select("_in", "_budget"), F.col("_source").eqNullSafe(F.col("_in"))).filter(F.col("_upto") > F.col("_budget"))
    edge = F.min(F.struct(place, (F.col("_budget") - F.col("_upto") + F.col("_n")).alias("_left"))).alias("_edge")
    first = over.groupBy(F.col("_in").alias("_of")).agg(edge).select("_of", F.col(f"_edge.{place}").alias(cut), F.col("_edge._left").alias(left))
    return budgets.join(first, F.col("_in").eqNullSafe(F.col("_of")), "left").drop("_of")


def budgets(sized: DataFrame, source: str) -> DataFrame:
    """Of stored rows, per source: ``source_size``, ``target``, ``epochs``, the slice ``_cut`` that the fraction ends in, ``_left`` for it."""
    narrow = sized.select(F.col(source).alias("_source"), "_slice", "_size")
    coarse = F.floor(F.col("_slice") / PARTS).cast("bigint")
    sums = stored(narrow.groupBy("_source", coarse.alias("_coarse")).agg(F.sum("_size").alias("_n")))
    plan = source_targets(sums).withColumnRenamed("_source", "_in").withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_EPOCHS)))
        .otherwise(0).cast("bigint"),
    )
    rest = F.floor(F.col("target") + 1e-6) - F.col("epochs") * F.col("source_size")
    plan = plan.withColumn("_budget", F.greatest(rest, F.lit(0)).cast("bigint"))
    sliced = stored(_where_it_ends(sums, plan, "_coarse", "_cut_coarse", "_rest"))
    # Tables of a row per source are stored, so that Spark knows their size when it plans a join with rows.
    edges = sliced.select(F.col("_in").alias("_edge_of"), "_cut_coarse")
    at_edge = narrow.join(edges, F.col("_source").eqNullSafe(F.col("_edge_of")) & (coarse == F.col("_cut_coarse")))
    parts = at_edge.groupBy("_source", "_slice").agg(F.sum("_size").alias("_n"))
    cut = _where_it_ends(parts, sliced.drop("_budget").withColumnRenamed("_rest", "_budget"), "_slice", "_cut", "_left")
    return stored(cut.select("_in", "source_size", "target", "epochs", F.coalesce("_cut", F.lit(COARSE * PARTS)).alias("_cut"), "_left"))


def take_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", with_text: bool = True
) -> DataFrame:
    """All columns of ``docs``, the text only ``with_text``, and ``_size``, ``source_size``, ``target``, ``epochs``, ``_part``, ``_taken``.

    ``_taken`` is ``epochs`` times the size plus ``_part``, the words of the last, fractional epoch.
    Tables of a row per source meet the rows by an ordinary join: Spark sends them out if they
    are small, and else splits a source that has most rows.
    """
    sized = measured(docs, key, text, source)
    sized = stored(sized if with_text else sized.drop(text))
    placed = sized.join(budgets(sized, source), F.col(source).eqNullSafe(F.col("_in")))
    at_edge = F.col("_slice") == F.col("_cut")
    in_order = (
        Window.partitionBy("_in").orderBy("_draw", key, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_size").over(in_order), F.lit(0))
    part = F.least(F.col("_size"), F.greatest(F.col("_left") - before, F.lit(0)))
    inside = F.when(F.col("_slice") < F.col("_cut"), F.col("_size")).otherwise(0)
    rows = placed.filter(at_edge).withColumn("_part", part).unionByName(placed.filter(~at_edge).withColumn("_part", inside))
    taken = (F.col("epochs") * F.col("_size") + F.col("_part")).cast("bigint")
    return rows.withColumn("_taken", taken).drop("_in", "_draw", "_tie", "_slice", "_cut", "_left")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, in SQL functions: words are counted as they are cut off."""
    marked = F.split(text, rf"(?<={WORD[:-1]})(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(marked, F.lit(1), n.cast("int")), "")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed rows, with the columns of ``docs``: a row per epoch, and one cut to the words of the fraction."""
    own = ("_size", "source_size", "target", "epochs", "_part", "_taken")
    alias = {column: f"_doc{i}" for i, column in enumerate(docs.columns)}
    plain = docs.select(*(F.col(f"`{column}`").alias(name) for column, name in alias.items()))
    taken = take_words(plain, alias[key], alias[text], alias[source])
    cut = F.when(F.col("_part") < F.col("_size"), first_words(F.col(alias[text]), F.col("_part"))).otherwise(F.col(alias[text]))
    whole = F.when(F.col("epochs") > 0, F.array_repeat(F.col(alias[text]), F.col("epochs").cast("int"))).otherwise(F.array())
    texts = F.concat(whole.cast("array<string>"), F.when(F.col("_part") > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    rows = taken.withColumn("_text", F.explode(texts)).drop(*own)
    return rows.select(*(F.col("_text" if c == text else name).alias(c) for c, name in alias.items()))
