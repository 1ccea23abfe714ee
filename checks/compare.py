"""Run check queries against their oracles: python -m checks.compare [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLES
from checks.queries import QUERIES

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int = 8) -> SparkSession:
    """A local session as tests and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=key)


def types_of(df, description) -> list[str]:
    """Columns whose Spark type is not the oracle's."""
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    oracle = {d[0]: str(d[1]) for d in description}
    return [f"{n} {t} != {oracle[n]}" for n, t in df.dtypes if same.get(t) != oracle[n]]


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = sorted_rows(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    want_columns, want = sorted_rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if wrong := types_of(df, result.description):
        return False, "; ".join(wrong)
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return False, f"{len(got)} rows != {len(want)}; only spark {extra}; only oracle {missing}"
    return True, f"{len(got)} rows"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, failed = local_session(), duck(sf_dir), 0
    for name in argv[1:] or QUERIES:
        start = time.perf_counter()
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.perf_counter() - start:.1f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
