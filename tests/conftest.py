import glob
import os
from collections import Counter

import pytest
from helpers import DATA, plain, rows


@pytest.fixture(scope="session")
def spark():
    from kbforge.session import local_session

    return local_session("4", 4, "4g")


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return con


@pytest.fixture(scope="session")
def same_as_sql(spark, duck):
    def check(name, queries, sql):
        df = queries[name](spark, DATA)
        found = duck.execute(sql[name])
        names = [x[0] for x in found.description]
        assert sorted(names) == sorted(df.columns)
        places = [names.index(c) for c in sorted(names)]
        assert rows(df) == Counter(tuple(plain(r[i]) for i in places) for r in found.fetchall())

    return check
