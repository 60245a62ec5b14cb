import pytest

from sievework.functions import headings, text
from sievework.plans.records import export_records, load_records
from sievework.sources import runs, tables, tagged

RAW = """PMID- 7
DP  -
EDAT- 1999/01/02 00:00
JT  - J  Example
TI  - A long
      title - here
AB  - Foo
      PMID- 5 bar.
MH  - Consciousness/*physiology
MH  - *Awareness
PT  - Review

PMID- 8
TI  - only a title

"""


def write(tmp_path, content, name="raw.txt"):
    path = tmp_path / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_of_the_fixture(spark, tmp_path, newline):
    path = write(tmp_path, RAW.replace("\n", newline))
    seven, eight = load_records(spark, path, newline).orderBy("pmid").collect()
    assert (seven.year, seven.journal, seven.title) == ("1999", "J Example", "A long title - here")
    assert seven.abstract == "Foo PMID- 5 bar."
    assert seven.mesh == ["Consciousness/*physiology", "*Awareness"]
    assert (seven.mesh_terms, seven.pub_types) == ("Consciousness/*physiology | *Awareness", "Review")
    flags = (seven.has_mesh_consciousness, seven.has_mesh_consciousness_major, seven.has_mesh_spirit_religion, seven.n_mesh)
    assert flags == (1, 1, 0, 2)
    assert (eight.title, eight.year, eight.abstract, eight.mesh_terms, eight.n_mesh) == ("only a title", "", "", "", 0)


@pytest.mark.parametrize("split", [700, 1000, 3001])
def test_each_record_is_read_once_however_the_file_is_split(spark, tmp_path, split):
    many = "".join(f"PMID- {i}\nTI  - title {i}\nAB  - text\n      PMID- {i + 5} more {'x' * (i % 90)}\n\n" for i in range(300))
    path = write(tmp_path, many)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records = load_records(spark, path)
        assert records.rdd.getNumPartitions() > 5
        assert sorted(r.pmid for r in records.collect()) == list(range(300))
        assert tagged.count_records(spark, path).first()[0] == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_invalid_bytes_are_dropped(spark, tmp_path):
    path = write(tmp_path, b"PMID- 1\nTI  - ab\xffcd\xc3\xa9\n\n")
    assert load_records(spark, path).first().title == "abcdé"


def test_genuine_replacement_characters_stay(spark, tmp_path):
    # Damage before, between and right at genuine ones, and the code point that marks them.
    path = write(tmp_path, b"PMID- 1\nTI  - a\xef\xbf\xbdb\xffc\xe2\x82\xef\xbf\xbd\xef\xb7\x901\xef\xb7\x900\xf3\n\nPMID- 2\nTI  - \xef\xbf\xbd\n")
    assert [r.title for r in load_records(spark, path).orderBy("pmid").collect()] == ["a\ufffdbc\ufffd\ufdd01\ufdd00", "\ufffd"]


@pytest.mark.parametrize(
    "mesh, expected, starred",
    [
        (["Consciousness"], (1, 0, 0, 1), (1, 0)),
        (["Consciousness/*physiology"], (1, 1, 0, 1), (1, 1)),
        (["*Consciousness"], (0, 0, 0, 1), (1, 1)),
        (["consciousness"], (0, 0, 0, 1), (0, 0)),
        (["Consciousness Disorders", "Religion"], (1, 0, 1, 2), (1, 0)),
        (["Religion and Psychology"], (0, 0, 0, 1), (0, 0)),
        (None, (0, 0, 0, 0), (0, 0)),
    ],
)
def test_heading_flags(spark, mesh, expected, starred):
    df = spark.createDataFrame([(mesh,)], "mesh array<string>")
    row = df.select(
        headings.has_heading("mesh"),
        headings.has_heading_major("mesh"),
        headings.has_heading("mesh", headings.EXCLUDE_HEADINGS),
        headings.n_heading("mesh"),
        headings.has_heading("mesh", strip_star=True),
        headings.has_heading_major("mesh", strip_star=True),
    ).first()
    assert tuple(row) == expected + starred


def test_norm_ws_and_year(spark):
    df = spark.createDataFrame([("  a\t\n b  c ", "Spring 2001", ""), (None, None, "1999/01")], "s string, dp string, ed string")
    rows = df.select(text.norm_ws("s").alias("s"), text.pub_year("dp", "ed").alias("y")).collect()
    assert [tuple(r) for r in rows] == [("a b c", "Spri"), ("", "1999")]


def test_csv_round_trip_keeps_quotes_and_blanks(spark, tmp_path):
    path = write(tmp_path, RAW.replace("only a title", 'he said "a, b" \\ c'))
    stored = export_records(spark, path, str(tmp_path / "p"), str(tmp_path / "c"))
    back = tables.read_record_table(spark, str(tmp_path / "c"))
    assert back.orderBy("pmid").collect() == stored.select(*tagged.RECORD_COLUMNS).orderBy("pmid").collect()


def test_manifest_and_log(spark, tmp_path):
    import hashlib

    path = write(tmp_path, RAW)
    ids = spark.createDataFrame([(7,), (8,), (8,)], "pmid bigint")
    manifest = runs.run_manifest(spark, path, ids, "term", 1843, 2025, total_count=3)
    row = manifest.first()
    assert (row.total_count, row.ids_written, row.records_written, row.bytes) == (3, 2, 2, len(RAW))
    assert row.sha256 == hashlib.sha256(RAW.encode()).hexdigest()
    log = str(tmp_path / "log")
    runs.append_run_log(manifest, log)
    runs.append_run_log(manifest, log)
    assert spark.read.parquet(log).count() == 2


def test_field_default(spark):
    df = spark.createDataFrame([(None, None, None)], "t string, n int, l array<string>")
    assert tuple(text.field_default(df).first()) == ("", 0, [])


def test_loading_is_one_narrow_stage(spark, tmp_path):
    plan = load_records(spark, write(tmp_path, RAW))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_length_flag_counts_characters(spark):
    df = spark.createDataFrame([("é" * 250,), ("é" * 251,), (None,)], "abstract string")
    assert [r[0] for r in df.select(text.length_flag()).collect()] == [0, 1, 0]


def test_id_list(spark, tmp_path):
    ids = spark.createDataFrame([(3,), (1,), (3,)], "pmid bigint")
    tables.write_id_list(ids, str(tmp_path / "ids"))
    assert sorted(r.pmid for r in tables.read_id_list(spark, str(tmp_path / "ids")).collect()) == [1, 3]
