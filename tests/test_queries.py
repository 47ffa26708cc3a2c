"""Every query with SQL gives DuckDB's rows on the smallest tables; the others run."""

import os

import duckdb
import pytest

from tessarium.plans.catalogue import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def norm(values):
    return tuple(round(v, 5) if isinstance(v, float) else v for v in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((norm(r) for r in df.select(*cols).collect()), key=repr)
    if name not in ORACLE_SQL:
        return
    quoted = ", ".join('"' + c + '"' for c in cols)
    want = sorted((norm(r) for r in duck.execute(f"SELECT {quoted} FROM ({ORACLE_SQL[name]})").fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", ["candidates", "arg_spans", "ev_counts", "stakeholders_regex"])
def test_words_beside_letters_beyond_ascii_match_as_in_the_sql(name, spark, tmp_path):
    texts = ["o, no\u00f1ra", "\u00e9from it", "from\u00df, with\u00e9 x", "\u00f1by the\u00f1", "\u00c9The of\u00e9", "no_ not1", "that\u0301 for the\u00e9", None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "not from")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    df = QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
