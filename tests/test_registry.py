"""Driver contract: entry() smoke and every SQL-checked query against DuckDB at sf0.001."""
import math
import os
import sys

import duckdb
import pytest

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, table_hash  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 150 and "errors_x_cards" in df.columns


ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_equal(spark, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    con = duck(SF001)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert table_hash(df.columns, srows)[0] == table_hash(ocols, orows)[0]
