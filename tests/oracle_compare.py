"""Run catalogue queries next to their SQL and compare all values."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype("int64").where(df[c].notna(), None)
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    """Empty if equal, else what differs."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    a, b = canonical(spark_df), canonical(sql_df)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} of {len(a)} rows differ in {c}: {a.loc[i].to_dict()} / {b.loc[i].to_dict()}"
    return ""


def main() -> None:
    import __spark_entry__ as entry
    from meterloom.session import get_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(queries)
    for name in names:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in oracle:
                print(f"{name:32s} {took:6.1f}s rows {len(got)} (no SQL)", flush=True)
                continue
            want = con.sql(oracle[name]).df()
            sql_took = time.time() - start - took
            print(f"{name:32s} {took:6.1f}s sql {sql_took:5.1f}s rows {len(got):7d} {difference(got, want) or 'ok'}", flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"{name:32s} FAILED {type(error).__name__}: {str(error)[-1500:]}", flush=True)


if __name__ == "__main__":
    main()
