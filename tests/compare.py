"""Run registered queries in Spark and their DuckDB statements on the same
parquet files and compare row multisets (doubles already rounded)."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


SPARK_OF_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "DATE": "date", "BOOLEAN": "boolean", "HUGEINT": "hugeint", "FLOAT": "float"}


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, data_dir: str, keys=None, verbose=True) -> dict[str, str]:
    con = duck(data_dir)
    qs, sqls = queries(), oracle_sql()
    out = {}
    for key in keys or sorted(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, data_dir)
            srows = [tuple(r) for r in df.collect()]
            snames = df.columns
            stypes = dict(df.dtypes)
        except Exception as e:  # noqa: BLE001
            out[key] = f"spark error: {str(e).splitlines()[0][:300]}"
            print(key, out[key]) if verbose else None
            continue
        if key not in sqls:
            out[key] = f"no oracle ({len(srows)} rows)"
            continue
        try:
            res = con.execute(sqls[key])
            dnames = [d[0] for d in res.description]
            dtypes = {d[0]: SPARK_OF_DUCK.get(str(d[1]), str(d[1])) for d in res.description}
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            out[key] = f"duck error: {str(e).splitlines()[0][:300]}"
            print(key, out[key]) if verbose else None
            continue
        if sorted(snames) != sorted(dnames):
            out[key] = f"columns differ: spark={sorted(snames)} duck={sorted(dnames)}"
        elif stypes != dtypes:
            diff = {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
            out[key] = f"types differ: {diff}"
        else:
            a, b = rows_of(snames, srows), rows_of(dnames, drows)
            if a == b:
                out[key] = f"ok ({len(srows)} rows)"
            else:
                only_s = list((a - b).elements())[:3]
                only_d = list((b - a).elements())[:3]
                out[key] = (f"MISMATCH spark={len(srows)} duck={len(drows)} "
                            f"cols={sorted(snames)} only_spark={only_s} only_duck={only_d}")
        if verbose:
            print(f"{key}: {out[key]} [{time.time() - t0:.1f}s]", flush=True)
    return out


if __name__ == "__main__":
    from audival.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    res = compare(spark, data, keys)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
