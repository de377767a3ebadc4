"""Spark result against DuckDB result: same columns, same multiset of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(spark_df, con, sql: str) -> list[str]:
    names = sorted(spark_df.columns)
    spark_rows = Counter(tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect())
    con.execute(sql)
    found = sorted(d[0] for d in con.description)
    if found != names:
        return [f"columns {names} != {found}"]
    order = [[d[0] for d in con.description].index(n) for n in names]
    duck_rows = Counter(tuple(r[i] for i in order) for r in con.fetchall())
    out = []
    if spark_rows != duck_rows:
        out.append(f"rows {sum(spark_rows.values())} / {sum(duck_rows.values())}")
        out += [f"only spark: {r}" for r in list((spark_rows - duck_rows))[:3]]
        out += [f"only sql:   {r}" for r in list((duck_rows - spark_rows))[:3]]
    return out
