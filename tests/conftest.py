import datetime
import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from braid.session import session  # noqa: E402

DATA = os.environ.get("BRAID_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = session("tests", f"local[{os.environ.get('BRAID_TEST_CORES', '8')}]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def duck(path=DATA):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{path}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(df, sql, con):
    """Rows of df and of sql are equal as multisets, and so are the names of their columns."""
    names = df.columns
    rel = con.execute(sql)
    got = [d[0] for d in rel.description]
    assert sorted(got) == sorted(names), (sorted(got), sorted(names))
    at = [got.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    have = sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)
    assert len(have) == len(want)
    odd = [(a, b) for a, b in zip(have, want) if a != b]
    assert not odd, odd[:2]
