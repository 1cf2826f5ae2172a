"""Run queries and their SQL side by side: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from checks.views import TABLES
from handbill.session import tuned


def session(cores: str = "8") -> SparkSession:
    spark = (
        tuned(SparkSession.builder.master(f"local[{cores}]").appName("checks"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[bool, str]:
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLES:
        return True, f"{len(got)} rows, no SQL"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows"
    extra, missing = set(got) - set(want), set(want) - set(got)
    return False, (
        f"{len(got)} rows != {len(want)}; {len(extra)} extra, {len(missing)} missing, e.g. "
        f"{str(sorted(extra)[:2])[:700]} / {str(sorted(missing)[:2])[:700]}"
    )


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = session(), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - a report over all queries
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
