"""Run queries and their SQL twins side by side: ``python -m crosscheck.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from trackstrata.session import get_spark, holding


def local_spark(cpus: int = 8) -> SparkSession:
    spark = get_spark(
        "crosscheck",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _kind(dtype: str) -> str:
    text = dtype.upper()
    if text.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "STRING": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double"}.get(
        text, text.lower()
    )


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree in columns, types, row count and values; otherwise what differs."""
    twin = connection.sql(sql)
    ours = {f.name: _kind(f.dataType.simpleString()) for f in result.schema}
    theirs = {c: _kind(str(t)) for c, t in zip(twin.columns, twin.types)}
    if ours != theirs:
        return f"columns {sorted(set(ours.items()) ^ set(theirs.items()))}"
    mine, other = _rows(result.columns, result.collect()), _rows(twin.columns, twin.fetchall())
    if len(mine) != len(other):
        return f"{len(mine)} rows, twin has {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{a} != {b}"
    return None


def main(arguments: list[str]) -> int:
    from crosscheck.oracle import ORACLE
    from crosscheck.queries import QUERIES

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark, connection = local_spark(), duck(sf_dir)
    failures = 0
    for name in names:
        begun = time.time()
        try:
            with holding(spark):
                if name not in ORACLE:
                    problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
                else:
                    problem = difference(QUERIES[name](spark, sf_dir), connection, ORACLE[name])
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{name:30s} {time.time() - begun:6.2f}s  {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
