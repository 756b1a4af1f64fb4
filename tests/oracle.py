"""Runs a registered query and its SQL on the same tables and compares all rows."""

import datetime
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r)
    return sorted((tuple(_value(r[i]) for i in order) for r in records), key=key)


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, df.collect())


def sql_types(db, sql):
    """Column types by the names that Spark has for them."""
    result = db.sql(sql)
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double"}
    return {c: names.get(str(t), str(t)) for c, t in zip(result.columns, result.types)}


def sql_rows(db, sql):
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    return sorted(names), rows(names, result.fetchall())
