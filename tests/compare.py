"""Compare a Spark result with the SQL oracle's, ignoring row and column order."""

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return f"columns {columns} instead of {want_columns}"
    if len(rows) != len(want):
        return f"{len(rows)} rows instead of {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
