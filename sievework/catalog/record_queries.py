"""Registered queries: sources, sinks and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.catalog import base
from sievework.functions import headings, patterns, scores, text
from sievework.functions.scores import META_COLUMNS
from sievework.operators.sampling import BATCH_COLUMNS, bucket, select_batch_columns
from sievework.plans import records as record_plan
from sievework.session import scratch_path
from sievework.sources import runs, tables, tagged
from sievework.sources.tagged import RECORD_COLUMNS

_REC = "WITH " + base.sql_records()
_FLAG_REC = "WITH " + base.sql_records(phrases=True)
_ALL = ", ".join(RECORD_COLUMNS)


def _records(spark, sf):
    return base.records(spark, sf)


def read_tagged_records(spark, sf):
    return tagged.read_tagged_records(spark, base.tagged_files(spark, sf)).select(
        F.regexp_extract("value", r"\APMID- (\d+)", 1).cast("bigint").alias("pmid"),
        F.char_length(F.regexp_replace("value", r"\s+\z", "")).cast("bigint").alias("n_chars"),
    )


def parse_tagged_fields(spark, sf):
    fields = tagged.parse_tagged_fields(tagged.read_tagged_records(spark, base.tagged_files(spark, sf)))
    return fields.select(
        F.col("pmid").cast("bigint").alias("pmid"), "dp", "edat", "jt",
        text.norm_ws("ti").alias("ti"), text.norm_ws("ab").alias("ab"),
        F.concat_ws(";", "mh").alias("mh"), F.concat_ws(";", "pt").alias("pt"),
    )


def export_record_table(spark, sf):
    folder = scratch_path(spark, "export")
    record_plan.export_records(spark, base.tagged_files(spark, sf), f"{folder}/parquet", f"{folder}/csv")
    return tables.read_record_table(spark, f"{folder}/csv")


def read_labels(spark, sf):
    path = scratch_path(spark, "labels")
    reviewed = base.reviewed_labels(spark, sf).select("pmid", F.lit("a, \"b\"").alias("title"), F.col("label").alias("Human label"))
    tables.write_csv(reviewed, path)
    read = tables.read_labels(spark, path, "Human label", columns=["pmid", "title", "Human label"])
    return read.select("pmid", F.coalesce("label", F.lit("")).alias("label"))


def count_records(spark, sf):
    return tagged.count_records(spark, base.tagged_files(spark, sf))


def write_id_list(spark, sf):
    path = scratch_path(spark, "ids")
    tables.write_id_list(base.table(spark, sf, "lineitem"), path, "l_orderkey")
    return tables.read_id_list(spark, path)


def read_damaged_records(spark, sf):
    """Records with damaged bytes and with genuine replacement characters: only the damage goes."""
    read = tagged.read_tagged_records(spark, base.damaged_files(spark, sf))
    fields = tagged.parse_tagged_fields(read)
    whole = read.select(F.regexp_extract("value", r"\APMID- (\d+)", 1).alias("pmid"), F.sha2(F.regexp_replace("value", r"\s+\z", "").cast("binary"), 256).alias("sha256"))
    return fields.select("pmid", "ti").join(whole, "pmid").select(F.col("pmid").cast("bigint").alias("pmid"), text.norm_ws("ti").alias("ti"), "sha256")


def _manifest(spark, sf):
    path = base.numbered_tagged_files(spark, sf)
    ids = base.table(spark, sf, "documents").select(F.col("doc_id").alias("pmid"))
    return runs.run_manifest(spark, path, ids, "consciousness", 1843, 2025)


def _files(manifest, *columns):
    """The manifest with the number of each raw file in place of its path."""
    number = F.regexp_extract("file", r"part=(-?\d+)", 1).cast("bigint").alias("part")
    return manifest.select(*columns, number, "total_count", "ids_written", "records_written", "bytes", "sha256")


def run_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    runs.write_manifest(_manifest(spark, sf), path)
    return _files(spark.read.json(path), "term", "min_key", "max_key")


def append_run_log(spark, sf):
    path = scratch_path(spark, "runs")
    manifest = _manifest(spark, sf)
    runs.append_run_log(manifest, path)
    runs.append_run_log(manifest.withColumn("min_key", F.lit(1900)), path)
    return _files(spark.read.parquet(path), "min_key", "max_key")


def norm_ws(spark, sf):
    return _records(spark, sf).select("pmid", "journal", "title", "abstract")


def pub_year(spark, sf):
    return _records(spark, sf).select("pmid", "year")


def field_default(spark, sf):
    """Outer join leaves records without a label; their fields get defaults."""
    kept = _records(spark, sf).select("pmid", F.nullif("title", F.lit("")).alias("title"), F.when(F.size("mesh") > 0, F.col("mesh")).alias("mesh"))
    joined = kept.join(base.labels(spark, sf), "pmid", "left")
    filled = text.field_default(joined, ["title", "mesh", "label"])
    return filled.select("pmid", "title", F.size("mesh").alias("n_mesh"), "label")


def join_list(spark, sf):
    return _records(spark, sf).select("pmid", "mesh_terms", "pub_types")


def has_heading(spark, sf):
    rec = _records(spark, sf)
    return rec.select(
        "pmid", "has_mesh_consciousness", "has_mesh_spirit_religion",
        headings.has_heading("mesh", strip_star=True).alias("has_starred"),
    )


def has_heading_major(spark, sf):
    return _records(spark, sf).select(
        "pmid", "has_mesh_consciousness_major",
        headings.has_heading_major("mesh", strip_star=True).alias("has_starred_major"),
    )


def n_heading(spark, sf):
    return _records(spark, sf).select("pmid", "n_mesh")


def batch_columns(spark, sf):
    return select_batch_columns(_records(spark, sf))


def build_text(spark, sf):
    return _records(spark, sf).select("pmid", text.build_text().alias("text"))


def build_flag_text(spark, sf):
    return _records(spark, sf).select("pmid", text.build_flag_text().alias("flag_text"))


def build_meta(spark, sf):
    return scores.build_meta(_records(spark, sf)).select("pmid", *META_COLUMNS)


def text_flags(spark, sf):
    rec = base.records(spark, sf, phrases=True).select("pmid", "title", "abstract")
    return text.text_flags(rec, patterns.FLAG_PATTERNS, patterns.FLAG_LITERALS).drop("title", "abstract")


FREQUENT = {
    "mentions_the": r"\bthe\b",
    "mentions_of_or_is": r"\bof\b|\bis\b",
    "mentions_la": r"\bla\b",
    "starts_th": r"\bth",
    "ends_tion": r"tion\b",
}


def text_flags_frequent(spark, sf):
    """The flag operator with frequent words as patterns."""
    return text.text_flags(_records(spark, sf).select("pmid", "title", "abstract"), FREQUENT).drop("title", "abstract")


def text_flags_v0(spark, sf):
    rec = base.records(spark, sf, phrases=True).select("pmid", "title", "abstract")
    return (
        text.text_flags(rec, patterns.FIRST_PATTERNS)
        .withColumn(patterns.LENGTH_FLAG, text.length_flag())
        .drop("title", "abstract")
    )


def length_flag(spark, sf):
    return _records(spark, sf).select("pmid", text.length_flag().alias(patterns.LENGTH_FLAG))


def bucket_predicate(spark, sf):
    return _records(spark, sf).select("pmid", bucket().alias("bucket"))


_EDGE = r"[^\p{L}\p{N}_]"


def _re2(pattern: str) -> str:
    """The pattern with word edges that RE2 can express; the edge may use up a character."""
    out, rest = "", pattern
    while r"\b" in rest:
        before, rest = rest.split(r"\b", 1)
        out += before
        out += f"(?:^|{_EDGE})" if rest[:1].isalnum() or rest[:1] == "(" else f"(?:{_EDGE}|$)"
    out += rest
    return out.replace(r"\w", r"[\p{L}\p{N}_]").replace(r"\W", _EDGE)


def _sql_flags(flags) -> str:
    return ", ".join(f"CAST(regexp_matches(t, '{_re2(p)}') AS INTEGER) AS {name}" for name, p in flags.items())


_FLAG_TEXT = "(SELECT *, lower(concat(title, chr(10), abstract)) AS t FROM rec)"
_BUCKET = (
    "CASE WHEN has_mesh_consciousness_major = 1 THEN 'major' WHEN has_mesh_consciousness = 1 THEN 'any' ELSE 'none' END"
)
_LONG = "CAST(length(abstract) > 250 AS INTEGER) AS len_abstract_over_250"


def _fold(column: str) -> str:
    return f"replace({column}, chr(10), concat(chr(10), '      '))"


_RENDERED = (
    "concat('PMID- ', pmid, chr(10), 'DP  - ', date, chr(10), 'EDAT- ', entered, chr(10), 'JT  - ', journal, chr(10), "
    f"'TI  - ', {_fold('title')}, chr(10), 'AB  - ', {_fold('abstract')}, chr(10), "
    "array_to_string([concat('MH  - ', m, chr(10)) FOR m IN mesh], ''), "
    "array_to_string([concat('PT  - ', p, chr(10)) FOR p IN pub_type_list], ''))"
)
_FILES = (
    f"CAST(floor(pmid / {base.DOCS_PER_FILE}) AS BIGINT) AS part, (SELECT count(*) FROM raw) AS total_count, "
    "(SELECT count(DISTINCT pmid) FROM raw) AS ids_written, (SELECT count(*) FROM raw) AS records_written, "
    f"CAST(sum(octet_length(encode({_RENDERED})) + 1) AS BIGINT) AS bytes, "
    f"sha256(string_agg(concat({_RENDERED}, chr(10)), '' ORDER BY pmid)) AS sha256"
)
# Genuine replacement characters, and a code point that the reader uses as a mark, stay.
_DAMAGED = "(SELECT * REPLACE (concat(chr(65533), chr(64976), title, chr(65533)) AS title) FROM raw)"

QUERIES = {
    "read_tagged_records": (
        read_tagged_records,
        _REC + rf" SELECT pmid, length(regexp_replace({_RENDERED}, '\s+$', '')) AS n_chars FROM raw",
    ),
    "read_damaged_records": (
        read_damaged_records,
        _REC + rf" SELECT pmid, {base.sql_norm('title')} AS ti, sha256(regexp_replace({_RENDERED}, '\s+$', '')) AS sha256 FROM {_DAMAGED}",
    ),
    "parse_tagged_fields": (
        parse_tagged_fields,
        _REC + f" SELECT pmid, date AS dp, entered AS edat, journal AS jt, {base.sql_norm('title')} AS ti, "
        f"{base.sql_norm('abstract')} AS ab, array_to_string(mesh, ';') AS mh, "
        "array_to_string(pub_type_list, ';') AS pt FROM raw",
    ),
    "export_record_table": (export_record_table, _REC + f" SELECT {_ALL} FROM rec"),
    "read_labels": (read_labels, "WITH " + base.SQL_REVIEWED + " SELECT pmid, label FROM reviewed"),
    "count_records": (count_records, "SELECT count(*) AS n_records FROM documents"),
    "write_id_list": (write_id_list, "SELECT DISTINCT l_orderkey AS pmid FROM lineitem"),
    "run_manifest": (
        run_manifest,
        _REC + f" SELECT 'consciousness' AS term, CAST(1843 AS BIGINT) AS min_key, CAST(2025 AS BIGINT) AS max_key, {_FILES} "
        f"FROM raw GROUP BY CAST(floor(pmid / {base.DOCS_PER_FILE}) AS BIGINT)",
    ),
    "append_run_log": (
        append_run_log,
        _REC + f" SELECT CAST(y AS INTEGER) AS min_key, CAST(2025 AS INTEGER) AS max_key, {_FILES} "
        f"FROM raw, (VALUES (1843), (1900)) v(y) GROUP BY y, CAST(floor(pmid / {base.DOCS_PER_FILE}) AS BIGINT)",
    ),
    "norm_ws": (norm_ws, _REC + " SELECT pmid, journal, title, abstract FROM rec"),
    "pub_year": (pub_year, _REC + " SELECT pmid, year FROM rec"),
    "field_default": (
        field_default,
        _REC + ", " + base.SQL_LABELS + " SELECT pmid, title, n_mesh, coalesce(label, 0) AS label FROM rec LEFT JOIN lab USING (pmid)",
    ),
    "join_list": (join_list, _REC + " SELECT pmid, mesh_terms, pub_types FROM rec"),
    "has_heading": (
        has_heading,
        _REC + " SELECT pmid, has_mesh_consciousness, has_mesh_spirit_religion, "
        "CAST(len([t FOR t IN mesh IF replace(split_part(t, '/', 1), '*', '') IN "
        "('Consciousness', 'Awareness', 'Consciousness Disorders')]) > 0 AS INTEGER) AS has_starred FROM rec",
    ),
    "has_heading_major": (
        has_heading_major,
        _REC + " SELECT pmid, has_mesh_consciousness_major, "
        "CAST(len([t FOR t IN mesh IF contains(t, '*') AND replace(split_part(t, '/', 1), '*', '') IN "
        "('Consciousness', 'Awareness', 'Consciousness Disorders')]) > 0 AS INTEGER) AS has_starred_major FROM rec",
    ),
    "n_heading": (n_heading, _REC + " SELECT pmid, n_mesh FROM rec"),
    "select_batch_columns": (batch_columns, _REC + f" SELECT {', '.join(BATCH_COLUMNS)}, '' AS label FROM rec"),
    "build_text": (build_text, _REC + " SELECT pmid, concat(title, ' ', chr(10), ' ', abstract) AS text FROM rec"),
    "build_flag_text": (
        build_flag_text,
        _REC + " SELECT pmid, lower(concat(title, chr(10), abstract)) AS flag_text FROM rec",
    ),
    "build_meta": (
        build_meta,
        _REC + " SELECT pmid, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in META_COLUMNS) + " FROM rec",
    ),
    "text_flags": (text_flags, _FLAG_REC + f" SELECT pmid, {_sql_flags(patterns.FLAG_PATTERNS)} FROM {_FLAG_TEXT}"),
    "text_flags_frequent": (text_flags_frequent, _REC + f" SELECT pmid, {_sql_flags(FREQUENT)} FROM {_FLAG_TEXT}"),
    "text_flags_v0": (
        text_flags_v0,
        _FLAG_REC + f" SELECT pmid, {_sql_flags(patterns.FIRST_PATTERNS)}, {_LONG} FROM {_FLAG_TEXT}",
    ),
    "length_flag": (length_flag, _REC + f" SELECT pmid, {_LONG} FROM rec"),
    "bucket_predicate": (bucket_predicate, _REC + f" SELECT pmid, {_BUCKET} AS bucket FROM rec"),
}
