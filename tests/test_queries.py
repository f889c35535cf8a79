"""Every query of the library proper against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import pytest

from marlstone.operators import scalars
from marlstone.queries import QUERIES

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        if Path(f"{D}/{t}.parquet").exists():
            c.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return round(float(v), 5) if hasattr(v, "is_finite") else int(v) if isinstance(v, bool) else v


EVERY = QUERIES | {f"{n} by hand": q for n, q in scalars.FIXTURES.items() if n in scalars.OVER_TABLES}


@pytest.mark.parametrize("name", list(EVERY))
def test_query(spark, duck, name):
    query, sql = EVERY[name]
    df = query(spark, D)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert sql, "every query here has its SQL"
    rel = duck.sql(sql)
    assert sorted(rel.columns) == columns
    want = sorted((tuple(plain(dict(zip(rel.columns, r))[c]) for c in columns) for r in rel.fetchall()), key=repr)
    assert got == want
