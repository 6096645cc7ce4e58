"""Compare a Spark result with the DuckDB result of its oracle statement."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else number
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()[:10]
    return str(value)


def _rows(names, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql: str) -> str:
    """Empty when names, row count and every value agree exactly."""
    mine_names, mine = _rows(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    their_names, theirs = _rows([d[0] for d in result.description], result.fetchall())
    if mine_names != their_names:
        return f"columns differ: {mine_names} / {their_names}"
    if len(mine) != len(theirs):
        return f"row counts differ: {len(mine)} / {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} rows differ of {len(mine)}, e.g. {mine_names}\n{bad[0][0]}\n{bad[0][1]}" \
        if bad else ""
