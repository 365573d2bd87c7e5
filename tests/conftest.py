import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    db = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split():
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return db


def plain(value):
    """A value as a text that is equal for equal values of either engine."""
    if value is None or isinstance(value, bool):
        return repr(value)
    if isinstance(value, float):
        return repr(int(value)) if value == int(value) else repr(round(value, 9))
    if isinstance(value, (list, tuple)):
        return repr([plain(v) for v in value])
    return repr(value)


def rows_of(frame, columns):
    return sorted(tuple(plain(r[c]) for c in columns) for r in frame.select(*[f"`{c}`" for c in columns]).collect())


def same_rows(frame, relation):
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    assert rows_of(frame, columns) == sorted(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
