"""Every query with SQL gives the same rows in Spark and DuckDB."""

import glob
import os

import duckdb
import pytest

from headwater.plans import daily
from headwater.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda x: f"{x:.6f}" if isinstance(x, float) else str(x)
    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    found = con.execute(SQL[name])
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), [d[0] for d in found.description])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_greedy_groups_follow_the_order(spark, sf):
    t = daily._kept(spark, sf).select("kst_date", "pos", "tokens").collect()
    days = {}
    for r in sorted(t, key=lambda r: (r.kst_date, r.pos)):
        days.setdefault(r.kst_date, []).append((r.pos, set(r.tokens)))
    want = {}
    for day, rows in days.items():
        groups = []
        for pos, own in rows:
            scores = [max(len(own & x) / len(own | x) for _, x in g) for g in groups]
            best = max(range(len(groups)), key=lambda i: (scores[i], -i), default=None)
            if best is None or scores[best] < 0.4:
                groups.append([])
                best = len(groups) - 1
            groups[best].append((pos, own))
            want[day, pos] = best
    assert {(r.kst_date, r.pos): r.group_id for r in QUERIES["greedy_groups"](spark, sf).collect()} == want
