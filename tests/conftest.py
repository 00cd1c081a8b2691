import os
import sys
import tempfile
from pathlib import Path

import duckdb
import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH", "")])])
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='spark-')}")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="session")
def same(spark, data, duck):
    """Holds a registered query against its SQL, row by row."""

    def check(query, sql):
        df = query(spark, data)
        names = sorted(df.columns)
        got = [tuple(plain(r[c]) for c in names) for r in df.collect()]
        found = duck.execute(sql)
        theirs = [x[0] for x in found.description]
        assert sorted(theirs) == names
        want = [tuple(plain(r[theirs.index(c)]) for c in names) for r in found.fetchall()]
        key = lambda r: tuple(map(str, r))
        assert sorted(got, key=key) == sorted(want, key=key)

    return check
