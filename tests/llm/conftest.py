import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """Local tests have no cluster folder; they set their own."""
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def docs_rows():
    return duckdb.connect().execute(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(shared, docs_rows):
    """The small documents with every odd case: nulls, empty, long, repeated rows, ties, and clashing names."""
    long = ("word " * 9 + "\n\n  ") * 3000 + "z" * 5000
    base = [tuple(r) for r in docs_rows[:60]]
    extra = [
        (10_000, None, "en", "src1", None), (10_001, "", None, None, 0), (10_002, " \n\t ", "de", "src1", 4), (10_003, long, "en", None, len(long)), (10_004, long, None, "é", len(long)),
        (10_005, "one", "en", "src2", 3), (10_006, "ONE", "en", "src2", 3), (10_006, "ONE", "en", "src2", 3), (None, "no id at all here", "en", "src2", 17), (None, "no id at all here", "en", "src2", 17),
        (10_007, "12 34 --", "en", "src2", 8), (10_008, "ünï " * 40, "fr", "src3", 160), (10_009, "a" * 300, "en", "src3", 300), (-5, base[3][1], "en", "src0", 1),
    ]
    rows = base + extra
    frame = shared.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    clashing = {n: F.lit("x") for n in ("_id", "_text", "_h", "_fp", "_box", "row", "_row", "key", "kind", "_cell", "_bits", "_size", "_source", "target", "kept", "_doc", "_tag", "score", "ids", "group")}
    return frame.withColumns(clashing), rows


@pytest.fixture(scope="session")
def empty(shared):
    return shared.createDataFrame([], SCHEMA)
