"""Compare every registered query with its check SQL: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata"


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value) if value is not None else None


FAMILY = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
    "tinyint": "TINYINT", "date": "DATE", "timestamp": "TIMESTAMP",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {sorted(set(names) ^ set(relation.columns))}"
    theirs = dict(zip(relation.columns, (str(t) for t in relation.types)))
    kinds = {c: (k, theirs[c]) for c, k in df.dtypes if k in FAMILY and FAMILY[k] != theirs[c]}
    ours = Counter(tuple(plain(r[n]) for n in names) for r in df.toLocalIterator())
    at = [relation.columns.index(n) for n in names]
    want = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    if ours != want:
        missing, extra = list((want - ours).elements()), list((ours - want).elements())
        return f"rows {sum(ours.values())} vs {sum(want.values())}; missing {missing[:2]}; extra {extra[:2]}; columns {names}"
    return f"types {kinds}" if kinds else None


def main() -> None:
    import __spark_entry__ as contract
    from lectern.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con, checks, bad = duck(sf_dir), contract.oracle_sql(), []
    for name, build in contract.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in checks:
                problem = compare(df, con, checks[name])
                status = "ok" if problem is None else "DIFF " + problem
            else:
                status = f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            status = f"ERROR {type(error).__name__} {str(error)[:900]}"
        if not status.startswith(("ok", "rows")):
            bad.append(name)
        print(f"{time.time() - started:6.1f}s {name:28} {status}", flush=True)
        spark.catalog.clearCache()
    print("failed:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
