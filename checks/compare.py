"""Compare every registered query with its SQL on the given tables (run as a module)."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import ORACLES, QUERIES
from checks.frames import Frames
from checks.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def bag(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    texts = sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)
    return [columns[i] for i in order], texts


def compare(name: str, frames: Frames, con: duckdb.DuckDBPyConnection) -> tuple[bool, str]:
    df = QUERIES[name](frames)
    mine = bag(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return True, f"{len(mine[1])} rows, no SQL"
    out = con.execute(ORACLES[name])
    theirs = bag([d[0] for d in out.description], out.fetchall())
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} != {theirs[0]}"
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return False, (
            f"{len(mine[1])} rows against {len(theirs[1])}; only here {sorted(a - b)[:2]};"
            f" only there {sorted(b - a)[:2]}"
        )
    return True, f"{len(mine[1])} rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            ok, note = compare(name, Frames(spark, sf_dir), con)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note[:900]}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
