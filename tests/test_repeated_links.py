"""Days on which several pages have one link, in another order of time than of pages: the same in Spark and DuckDB."""

import duckdb
import pytest

from headwater.plans.catalog import QUERIES, SQL
from tests.test_catalog import plain


@pytest.fixture(scope="module")
def repeats(sf, tmp_path_factory):
    """Seven days, of rules, of answers and of neither, of about seven pages with three links."""
    folder = str(tmp_path_factory.mktemp("repeats"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE pages AS SELECT page_id, 'https://a.org/' || page_id % 3 AS url, html FROM '{sf}/pages.parquet'")
    con.execute(f"CREATE TABLE documents AS SELECT * FROM '{sf}/documents.parquet'")
    con.execute(f"CREATE TABLE events AS SELECT * REPLACE (TIMESTAMP '2024-01-03' + to_days(CAST(event_id % 7 AS INT)) + to_seconds(9000 - 7 * CAST(event_id AS INT)) AS ts) FROM '{sf}/events.parquet'")
    for name in ("pages", "documents", "events"):
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder, con


@pytest.mark.parametrize("name", ["judged_days", "judged_groups"])
def test_days_with_repeated_links_are_judged_as_in_sql(spark, repeats, name):
    folder, con = repeats
    df = QUERIES[name](spark, folder)
    found = con.execute(SQL[name])
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), [d[0] for d in found.description])
