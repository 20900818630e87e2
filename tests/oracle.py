"""Compare a query with its SQL in DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def same(df, con, sql):
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    order = [columns.index(n) for n in sorted(columns)]
    want = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(columns) == names
    assert got == want
