"""Raw tagged record files: one ``TAG - value`` line per value, blank line between records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import headings, text

# Tags of the fields, by output column.
SCALAR_TAGS = {"pmid": "PMID", "dp": "DP", "edat": "EDAT", "jt": "JT", "ti": "TI", "ab": "AB"}
LIST_TAGS = {"mh": "MH", "pt": "PT"}

# Columns of the record table.
RECORD_COLUMNS = (
    "pmid", "year", "journal", "title", "abstract", "mesh_terms", "pub_types",
    "has_mesh_consciousness", "has_mesh_consciousness_major", "has_mesh_spirit_religion", "n_mesh",
)


# A code point that stands for nothing, to mark replacement characters that a text really holds; and the replacement character.
_ESCAPE, _REPLACEMENT = "\ufdd0", "\ufffd"


def _without_damage(value: Column) -> Column:
    """Text without its invalid bytes. Repair puts replacement characters in their place, so genuine ones are marked first."""
    marked = F.replace(F.replace(value, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")), F.lit(_REPLACEMENT), F.lit(_ESCAPE + "1"))
    dropped = F.replace(F.make_valid_utf8(marked), F.lit(_REPLACEMENT), F.lit(""))
    return F.replace(F.replace(dropped, F.lit(_ESCAPE + "1"), F.lit(_REPLACEMENT)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))


def read_tagged_records(spark: SparkSession, path, newline: str = "\n") -> DataFrame:
    """One row per record. Large files are split, so a file may hold any number of records.

    Bytes that are not UTF-8 are dropped, and nothing else. Pass ``newline="\\r\\n"`` for files with
    such line ends.
    """
    raw = spark.read.text(path, lineSep=f"{newline}PMID- ")
    value = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(_without_damage(F.col("value")))
    if newline != "\n":
        value = F.replace(value, F.lit(newline), F.lit("\n"))
    # The separator takes the record's own first tag, but for the first record of a file.
    value = F.regexp_replace(value, r"\A\s*(?:PMID- )?", "")
    return raw.select(value.alias("value")).filter(F.trim("value") != "").select(
        F.concat(F.lit("PMID- "), "value").alias("value")
    )


def _values(lines: Column, tag: str) -> Column:
    """Values of every line that starts with the tag, trailing blanks removed."""
    prefix = tag.ljust(4) + "-"
    return F.transform(
        F.filter(lines, lambda line: line.startswith(prefix)),
        lambda line: F.regexp_replace(F.substr(line, F.lit(7)), r"\s+$", ""),
    )


def parse_tagged_fields(records: DataFrame) -> DataFrame:
    """Scalar fields as strings ("" if missing), headings and types as arrays."""
    unfolded = F.regexp_replace("value", r"[ \t\r]*\n {6}", " ")
    lines = F.col("_lines")
    return records.select(F.split(unfolded, "\n").alias("_lines")).select(
        *(F.concat_ws(" ", _values(lines, tag)).alias(name) for name, tag in SCALAR_TAGS.items()),
        *(_values(lines, tag).alias(name) for name, tag in LIST_TAGS.items()),
    )


def record_table(fields: DataFrame, strip_star: bool = False) -> DataFrame:
    """The record table, with the heading and type lists kept beside their joined text."""
    mesh = F.col("mh")
    return fields.select(
        F.expr("try_cast(trim(pmid) AS bigint)").alias("pmid"),
        text.pub_year("dp", "edat").alias("year"),
        text.norm_ws("jt").alias("journal"),
        text.norm_ws("ti").alias("title"),
        text.norm_ws("ab").alias("abstract"),
        mesh.alias("mesh"),
        text.join_list("mh").alias("mesh_terms"),
        F.col("pt").alias("pub_type_list"),
        text.join_list("pt").alias("pub_types"),
        headings.has_heading(mesh, headings.KEEP_HEADINGS, strip_star).alias("has_mesh_consciousness"),
        headings.has_heading_major(mesh, headings.KEEP_HEADINGS, strip_star).alias("has_mesh_consciousness_major"),
        headings.has_heading(mesh, headings.EXCLUDE_HEADINGS, strip_star).alias("has_mesh_spirit_religion"),
        headings.n_heading(mesh).alias("n_mesh"),
    )


def count_records(spark: SparkSession, path) -> DataFrame:
    """Number of record-start lines, one row."""
    return (
        spark.read.text(path)
        .filter(F.col("value").rlike(r"^PMID-\s"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def tagged_text(records: DataFrame, *keep: Column | str) -> DataFrame:
    """Render records with date, entered, mesh and pub_type_list as tagged text; columns ``keep`` stay beside it."""

    def line(tag: str, value) -> Column:
        folded = F.replace(F.coalesce(value, F.lit("")), F.lit("\n"), F.lit("\n      "))
        return F.concat(F.lit(tag.ljust(4) + "- "), folded)

    def many(tag: str, values: str) -> Column:
        prefix = tag.ljust(4) + "- "
        return F.transform(values, lambda v: F.concat(F.lit(prefix), v))

    body = F.concat(
        F.array(
            line("PMID", F.col("pmid").cast("string")),
            line("DP", F.col("date")),
            line("EDAT", F.col("entered")),
            line("JT", F.col("journal")),
            line("TI", F.col("title")),
            line("AB", F.col("abstract")),
        ),
        many("MH", "mesh"),
        many("PT", "pub_type_list"),
        F.array(F.lit("")),
    )
    return records.select(F.array_join(body, "\n").alias("value"), *keep)
