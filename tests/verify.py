"""Local oracle check: each catalog query against its DuckDB SQL.

    python -m tests.verify [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of
rows (floats to 12 significant digits).  Test helper; not used by the
library.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalars
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(records, cols) -> Counter:
    return Counter(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, sf_dir: str, names=None, con=None) -> dict:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry_mod

    qs = entry_mod.queries()
    sql = entry_mod.oracle_sql()
    con = con or duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        res = {"oracle": name in sql}
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sorted(sdf.columns)
            res["rows"] = len(srows)
            res["spark_s"] = round(time.time() - t0, 2)
            if name in sql:
                rel = con.sql(sql[name])
                dcols = sorted(rel.columns)
                drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
                res["oracle_rows"] = len(drows)
                res["columns_match"] = scols == dcols
                if scols == dcols:
                    a, b = rows_of(srows, scols), rows_of(drows, dcols)
                    res["values_match"] = a == b
                    if a != b:
                        res["only_spark"] = list((a - b).elements())[:3]
                        res["only_oracle"] = list((b - a).elements())[:3]
                else:
                    res["spark_cols"], res["oracle_cols"] = scols, dcols
        except Exception as e:  # report and go on
            res["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        out[name] = res
        print(name, res, flush=True)
    return out


def main(argv):
    from lampwatch.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or None
    spark = local_session()
    res = compare(spark, sf_dir, names)
    bad = [k for k, v in res.items()
           if "error" in v or (v.get("oracle") and not (v.get("values_match")
                                                       and v.get("rows") == v.get("oracle_rows")))]
    print("FAILED:", bad if bad else "none", f"({len(res)} queries)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
