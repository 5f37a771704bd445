"""Every query of the folder that has SQL, against it: names, types, and all rows."""

import pytest
from compare import connect, spark_rows, spark_types, sql_rows, sql_types

from tickweave.llm import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf_dir):
    con = connect(sf_dir)
    df = catalog.queries()[name](spark, sf_dir)
    assert spark_types(df) == sql_types(con, SQL[name])
    names, rows = spark_rows(df)
    wanted_names, wanted = sql_rows(con, SQL[name])
    assert names == wanted_names
    assert not rows - wanted and not wanted - rows
