"""Every registered query with oracle SQL equals DuckDB on sf0.001 (the driver's
gate runs the same comparison at sf0.01)."""

import os
import sys

import pytest

from support import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest, duck  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_key_is_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "n_docs", "n_chars"] and df.count() >= 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_lines, s_hash = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    d_cols, d_lines, d_hash = digest([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_lines) == len(d_lines)
    assert s_hash == d_hash, (sorted(set(s_lines) - set(d_lines))[:2], sorted(set(d_lines) - set(s_lines))[:2])
