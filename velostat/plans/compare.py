"""Compare a Spark result with a DuckDB oracle result, order-insensitively."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


# Spark type -> the DuckDB type an equal column has.
DUCKDB_TYPE = {
    "LongType": "BIGINT",
    "IntegerType": "INTEGER",
    "DoubleType": "DOUBLE",
    "StringType": "VARCHAR",
    "DateType": "DATE",
    "TimestampNTZType": "TIMESTAMP",
    "BooleanType": "BOOLEAN",
}


def same_types(spark_df, con, sql: str) -> tuple[bool, str]:
    mine = {f.name: DUCKDB_TYPE.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_df.schema.fields}
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    diff = {k: (mine.get(k), theirs.get(k)) for k in set(mine) | set(theirs) if mine.get(k) != theirs.get(k)}
    return (not diff), (f"types {diff}" if diff else "")


def same_result(spark_df, con, sql: str) -> tuple[bool, str]:
    ok, why = same_types(spark_df, con, sql)
    if not ok:
        return False, why
    rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    if sorted(spark_df.columns) != sorted(ocols):
        return False, f"columns {spark_df.columns} vs {ocols}"
    if len(rows) != len(orows):
        return False, f"rows {len(rows)} vs {len(orows)}"
    if canonical(spark_df.columns, rows) != canonical(ocols, orows):
        return False, "values differ"
    return True, ""
