"""DuckDB beside Spark, for tests."""

import duckdb

TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


def duck_rows(sql, sf_dir=None, tables=None):
    con = duckdb.connect()
    for t in TABLES if sf_dir else ():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name, frame in (tables or {}).items():
        con.register(name, frame)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=str)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=str)
