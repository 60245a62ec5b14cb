"""Inputs of the registered queries, derived from the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import headings, text
from sievework.session import scratch_path
from sievework.sources import tagged

MESH = (
    ("Consciousness/*physiology", "Humans"),
    ("Consciousness", "Brain/metabolism"),
    ("*Awareness", "Humans"),
    ("Religion", "Awareness"),
    (),
    ("Spirituality", "Pastoral Care/*methods"),
)
TYPES = (("Journal Article",), ("Journal Article", "Review"), ())
# One subject phrase per document gives the flag patterns something to find or to miss.
PHRASES = (
    "Consciousness,", "CONSCIOUS mind", "subconscious", "awareness", "Anesthesia", "anaesthesia", "in coma.",
    "comatose", "vegetative state", "Minimally-conscious", "minimally conscious", "locked-in", "lockedin", "sedated",
    "Propofol", "midazolam", "arousal", "wakefulness", "neurons", "connectivity", "philosophy", "qualia",
    "subjectivity", "phenomenology", "report", "reported", "religious", "spirituality", "global workspace", "IIT",
    "integrated information theory", "mind-brain identity", "Orch OR", "panpsychism", "substance dualism",
    "neutral monism", "electromagnetic fields", "neural correlate of consciousness", "physicalism", "Edelman",
    "Crick and Koch", "Dennett", "Baars", "McFadden", "Searle", "Chalmers", "Dehaene", "Tononi", "Friston", "plain",
    "process", "unaware", "global workspace theory", "sedation", "rats", "altered levels of consciousness", "alcohol",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(number: Column, values) -> Column:
    """The value at ``number`` modulo the count of values."""
    choice = F.array(*(F.lit(v) if isinstance(v, str) else F.array(*map(F.lit, v)).cast("array<string>") for v in values))
    return F.get(choice, F.pmod(number, F.lit(len(values))).cast("int"))


def raw_fields(spark: SparkSession, sf_dir: str, phrases: bool = False) -> DataFrame:
    """Documents as raw record fields: pmid, date, entered, journal, title, abstract, mesh, pub_type_list."""
    doc, key = F.col("text"), F.col("doc_id")
    year = (F.lit(1990) + F.pmod(key, F.lit(30))).cast("string")
    title = F.substring_index(doc, "\n", 1)
    if phrases:
        title = F.concat(_choose(key, PHRASES), F.lit(" "), title)
    cut = F.instr(doc, "\n")
    return table(spark, sf_dir, "documents").select(
        key.alias("pmid"),
        F.when(key % 4 == 0, "").when(key % 4 == 1, "Spring 2001").otherwise(F.concat(year, F.lit(" Jan"))).alias("date"),
        F.concat(year, F.lit("/01/02 00:00")).alias("entered"),
        F.concat(F.lit("Journal  of "), "source").alias("journal"),
        title.alias("title"),
        F.when(cut > 0, F.substr(doc, cut + 1)).otherwise("").alias("abstract"),
        _choose(key, MESH).alias("mesh"),
        _choose(key, TYPES).alias("pub_type_list"),
    )


def records(spark: SparkSession, sf_dir: str, phrases: bool = False) -> DataFrame:
    """The record table built straight from the documents."""
    return raw_fields(spark, sf_dir, phrases).select(
        "pmid",
        text.pub_year("date", "entered").alias("year"),
        text.norm_ws("journal").alias("journal"),
        text.norm_ws("title").alias("title"),
        text.norm_ws("abstract").alias("abstract"),
        "mesh",
        text.join_list("mesh").alias("mesh_terms"),
        "pub_type_list",
        text.join_list("pub_type_list").alias("pub_types"),
        headings.has_heading("mesh").alias("has_mesh_consciousness"),
        headings.has_heading_major("mesh").alias("has_mesh_consciousness_major"),
        headings.has_heading("mesh", headings.EXCLUDE_HEADINGS).alias("has_mesh_spirit_religion"),
        headings.n_heading("mesh").alias("n_mesh"),
    )


def tagged_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the documents as raw tagged files and return their path."""
    path = scratch_path(spark, "raw")
    tagged.tagged_text(raw_fields(spark, sf_dir)).write.text(path)
    return path


# Documents of one raw file, where files of known content are asked for.
DOCS_PER_FILE = 200


def numbered_tagged_files(spark: SparkSession, sf_dir: str) -> str:
    """As :func:`tagged_files`, but each file has the records of one range of ids, in order, in the folder ``part=<number>``."""
    path = scratch_path(spark, "raw")
    rows = raw_fields(spark, sf_dir)
    number = F.floor(F.col("pmid") / DOCS_PER_FILE).cast("bigint").alias("part")
    text = tagged.tagged_text(rows, "pmid", number)
    text.repartition("part").sortWithinPartitions("part", "pmid").drop("pmid").write.partitionBy("part").text(path)
    return path


def damaged_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw files whose titles hold a replacement character and, but for every third one, bytes that are no UTF-8."""
    path = scratch_path(spark, "damaged")
    text = tagged.tagged_text(raw_fields(spark, sf_dir).withColumn("title", F.concat(F.lit("\ufffd\ufdd0"), "title", F.lit("\ufffd"))), "pmid")
    broken = F.concat(F.regexp_replace("value", r"\s+\z", "").cast("binary"), F.when(F.col("pmid") % 3 > 0, F.unhex(F.lit("C3FFE282"))).otherwise(F.unhex(F.lit(""))))
    text.select(F.concat(broken, F.lit("\n").cast("binary")).cast("string").alias("value")).write.text(path)
    return path


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pmid"), F.col("quality").alias("label"))


def seed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as people spell them; every eleventh one is left out."""
    key, quality = F.col("doc_id"), F.col("quality")
    return table(spark, sf_dir, "labels").select(
        key.alias("pmid"),
        F.when(key % 11 == 0, "").when(quality == 1, _choose(key, ("1", " TRUE ", "Yes", "true")))
        .otherwise(_choose(key, ("0", "false", "No ", "1.0"))).alias("label"),
        key.alias("row_pos"),
    )


def reviewed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review of all labels that overturns the toxic ones and leaves the others blank or as they are."""
    key, quality = F.col("doc_id"), F.col("quality")
    return table(spark, sf_dir, "labels").select(
        key.alias("pmid"),
        F.when(F.col("toxic") == 1, (1 - quality).cast("string")).when(key % 5 == 0, quality.cast("string"))
        .otherwise("").alias("label"),
        key.alias("row_pos"),
    )


def tie_score(key: Column | str) -> Column:
    """A repeatable score with many ties."""
    digit = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 1), 16, 10).cast("int")
    return F.round(digit / F.lit(15.0), 4)


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with score and prediction."""
    scored = labels(spark, sf_dir).withColumn("model_prob", tie_score("pmid"))
    return scored.withColumn("pred", (F.col("model_prob") >= 0.5).cast("int"))


# --- the same inputs in SQL -------------------------------------------------

_WS = r"'[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'"


def sql_norm(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {_WS}, ' ', 'g'))"


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]::VARCHAR[]"


def sql_choose(key: str, values) -> str:
    cases = " ".join(
        f"WHEN {i} THEN " + (f"'{v}'" if isinstance(v, str) else _sql_list(v)) for i, v in enumerate(values)
    )
    return f"CASE {key} % {len(values)} {cases} END"


def sql_has(targets, star: bool = False) -> str:
    wanted = ", ".join(f"'{t}'" for t in targets)
    extra = " AND contains(t, '*')" if star else ""
    return f"CAST(len([t FOR t IN mesh IF split_part(t, '/', 1) IN ({wanted}){extra}]) > 0 AS INTEGER)"


def sql_records(phrases: bool = False) -> str:
    """Common table expressions ``raw`` and ``rec``."""
    title = "split_part(text, chr(10), 1)"
    if phrases:
        title = f"concat({sql_choose('doc_id', PHRASES)}, ' ', {title})"
    return f"""
    raw AS (
      SELECT doc_id AS pmid,
             CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN 'Spring 2001'
                  ELSE concat(1990 + doc_id % 30, ' Jan') END AS date,
             concat(1990 + doc_id % 30, '/01/02 00:00') AS entered,
             concat('Journal  of ', source) AS journal,
             {title} AS title,
             CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
             {sql_choose('doc_id', MESH)} AS mesh,
             {sql_choose('doc_id', TYPES)} AS pub_type_list
      FROM documents),
    rec AS (
      SELECT pmid, substr(CASE WHEN date = '' THEN entered ELSE date END, 1, 4) AS year,
             {sql_norm('journal')} AS journal, {sql_norm('title')} AS title, {sql_norm('abstract')} AS abstract,
             mesh, array_to_string(mesh, ' | ') AS mesh_terms, array_to_string(pub_type_list, ' | ') AS pub_types,
             {sql_has(headings.KEEP_HEADINGS)} AS has_mesh_consciousness,
             {sql_has(headings.KEEP_HEADINGS, star=True)} AS has_mesh_consciousness_major,
             {sql_has(headings.EXCLUDE_HEADINGS)} AS has_mesh_spirit_religion,
             CAST(len(mesh) AS INTEGER) AS n_mesh
      FROM raw)"""


SQL_LABELS = "lab AS (SELECT doc_id AS pmid, quality AS label FROM labels)"

SQL_SEED = f"""
    seed AS (
      SELECT doc_id AS pmid,
             CASE WHEN doc_id % 11 = 0 THEN ''
                  WHEN quality = 1 THEN {sql_choose('doc_id', ('1', ' TRUE ', 'Yes', 'true'))}
                  ELSE {sql_choose('doc_id', ('0', 'false', 'No ', '1.0'))} END AS label
      FROM labels)"""

SQL_REVIEWED = """
    reviewed AS (
      SELECT doc_id AS pmid,
             CASE WHEN toxic = 1 THEN CAST(1 - quality AS VARCHAR)
                  WHEN doc_id % 5 = 0 THEN CAST(quality AS VARCHAR) ELSE '' END AS label
      FROM labels)"""


def sql_label(expr: str) -> str:
    return (
        f"CAST(CASE WHEN lower(trim({expr})) IN ('1', 'true', 'yes') THEN 1 "
        f"WHEN lower(trim({expr})) IN ('0', 'false', 'no') THEN 0 END AS INTEGER)"
    )


def sql_score(key: str) -> str:
    return f"round((strpos('0123456789abcdef', substr(md5(CAST({key} AS VARCHAR)), 1, 1)) - 1) / 15.0, 4)"


SQL_SCORED = f"""
    scored AS (
      SELECT *, CAST(model_prob >= 0.5 AS INTEGER) AS pred
      FROM (SELECT doc_id AS pmid, quality AS label, {sql_score('doc_id')} AS model_prob FROM labels))"""


def sql_order(key: str, seed: int) -> str:
    return f"md5(concat('{seed}-', {key}))"
