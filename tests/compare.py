"""Rows of a Spark result and of its SQL in DuckDB, in one comparable form."""

import datetime
import decimal
import glob
import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normal(columns, cursor.fetchall())


def duck_types(con, sql):
    return {r[0]: str(r[1]).lower() for r in con.execute(f"DESCRIBE {sql}").fetchall()}


def spark_rows(df):
    return normal(df.columns, df.collect())


SAME_TYPE = {"varchar": "string", "integer": "int", "timestamp": "timestamp"}


def same_types(df, types):
    wrong = {}
    for name, actual in df.dtypes:
        wanted = SAME_TYPE.get(types[name], types[name])
        if actual.replace("timestamp_ntz", "timestamp") != wanted:
            wrong[name] = (actual, wanted)
    return wrong


def table_names(spark, target):
    rows = spark.sql(f"SHOW TABLES IN {target.namespace}").where("NOT isTemporary").collect()
    return {r.tableName for r in rows}
