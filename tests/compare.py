"""Order-insensitive comparison of a Spark result with the result of its SQL."""

import datetime
import decimal
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, decimal.Decimal):
        return f"DECIMAL {value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, con, sql, show=3):
    """Empty when both agree, else a short text."""
    spark_columns = frame.columns
    mine = rows_of(spark_columns, [tuple(r) for r in frame.collect()])
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = rows_of(columns, found.fetchall())
    if sorted(spark_columns) != sorted(columns):
        return f"columns {sorted(spark_columns)} / {sorted(columns)}"
    # Type names tell BIGINT from HUGEINT and DECIMAL, which print alike.
    kinds = {name: str(kind) for name, kind in zip(columns, (d[1] for d in found.description))}
    wide = {n: k for n, k in kinds.items() if "HUGEINT" in k or "DECIMAL" in k}
    if wide:
        return f"SQL types {wide}"
    if mine != theirs:
        only_mine = [r for r in mine if r not in set(theirs)][:show]
        only_theirs = [r for r in theirs if r not in set(mine)][:show]
        return (f"{len(mine)} / {len(theirs)} rows, {sorted(columns)}\n  spark {only_mine}"
                f"\n  sql   {only_theirs}")
    return ""
