"""Compare registered queries with their SQL twins: ``python tests/oracle.py [sf_dir] [name …]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(pdf):
    pdf = pdf.reindex(sorted(pdf.columns), axis=1)
    text = pdf.copy()
    for c in text.columns:
        if pd.api.types.is_float_dtype(text[c]):
            text[c] = text[c].map(lambda v: "null" if pd.isna(v) else repr(float(v)))
        else:
            text[c] = text[c].map(lambda v: "null" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else str(v))
    return sorted(map(tuple, text.itertuples(index=False, name=None)))


def differences(spark, con, run, sql, sf_dir):
    """None when both sides agree, else a short text."""
    left = run(spark, sf_dir).toPandas()
    if sql is None:
        return None if len(left) else "no rows"
    right = con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} / {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    kinds = lambda d: {c: ("num" if pd.api.types.is_float_dtype(t) else "int" if pd.api.types.is_integer_dtype(t) else str(t)) for c, t in d.dtypes.items()}
    a, b = canonical(left), canonical(right)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first {bad[0]} ; kinds {kinds(left)} / {kinds(right)}"
    if not len(left):
        return "no rows"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad, slow = connect(sf), e.oracle_sql(), 0, []
    chosen = {n: r for n, r in e.queries().items() if not args[1:] or any(n.startswith(a) for a in args[1:])}
    for name, run in chosen.items():
        t = time.time()
        try:
            d = differences(spark, con, run, sqls.get(name), sf)
        except Exception as error:  # noqa: BLE001
            d = f"{type(error).__name__}: {str(error)[:600]}"
        bad += d is not None
        slow.append((time.time() - t, name))
        print(f"{'ok  ' if d is None else 'FAIL'} {time.time() - t:6.2f}s {name}{'' if sqls.get(name) else ' (rows only)'} {d or ''}", flush=True)
    print(f"{len(chosen)} queries, {bad} bad, {sum(s for s, _ in slow):.1f}s")
