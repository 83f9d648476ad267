import math

import duckdb
import pytest

from topicflow.registry.views import Views
from topicflow.session import build_session

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8", shuffle=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    return Views(spark, SF)


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def same(left, right):
    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    if number(left) and number(right):
        return abs(left - right) <= 1e-8
    return left == right


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, round(v, 5) if isinstance(v, float) else v if not isinstance(v, bool) else int(v)) if not isinstance(v, str) else (False, v) for v in row))
