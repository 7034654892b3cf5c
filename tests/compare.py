"""Run registered queries in Spark and their SQL in DuckDB and compare.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_bool_dtype(column) or pd.api.types.is_integer_dtype(column):
            frame[name] = column.astype("float64")
        elif pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype("datetime64[us]").astype("int64").astype("float64")
        elif column.dtype == object or pd.api.types.is_string_dtype(column):
            sample = column.dropna()
            if len(sample) and hasattr(sample.iloc[0], "year"):
                frame[name] = pd.to_datetime(column).astype("datetime64[us]").astype("int64").astype("float64")
            elif len(sample) and isinstance(sample.iloc[0], str):
                frame[name] = column.astype(object).where(column.notna(), "\0null")
            else:
                frame[name] = column.astype("float64")
        else:
            frame[name] = column.astype("float64")
    frame = frame.sort_values(list(frame.columns), na_position="last")
    return frame.reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """Description of the first difference, None when equal as bags of rows."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    left, right = normal(spark_frame), normal(sql_frame)
    for name in left.columns:
        a, b = left[name], right[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = same.idxmin()
            return f"{name}: {(~same).sum()} differ, first\n  {left.loc[i].to_dict()}\n  {right.loc[i].to_dict()}"
    return None


_KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def type_differences(df, relation) -> list[str]:
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    return [
        f"{f.name}: {f.dataType.simpleString()} / {theirs[f.name]}"
        for f in df.schema
        if f.name in theirs and _KIND.get(theirs[f.name]) != f.dataType.simpleString()
    ]


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from covercast import catalog, oracle

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or sorted(catalog.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.driver.maxResultSize", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            df = catalog.queries()[name](spark, sf_dir)
            got = df.toPandas()
            mid = time.time()
            sql = oracle.oracle_sql().get(name)
            if sql is None:
                print(f"----  {name} {len(got)} rows, no SQL")
                continue
            relation = con.sql(sql)
            want = relation.df()
            problem = difference(got, want)
            types = type_differences(df, relation)
            took = f"{mid - start:.1f}s / {time.time() - mid:.1f}s"
        except Exception as error:  # noqa: BLE001
            got, problem, types, took = [], f"{type(error).__name__} {str(error)[:1500]}", [], ""
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'}  {name} {len(got)} rows {took} {problem or ''} {types or ''}", flush=True)
    print(f"{bad} of {len(wanted)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
