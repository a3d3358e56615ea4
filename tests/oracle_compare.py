"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Columns are matched by name, rows as an unordered multiset, values exactly.
Usable from tests and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...] [--json report.json]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    rows = sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)
    return names, rows


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose: bool = True) -> dict:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    queries, sqls = entry.queries(), entry.oracle_sql()
    con = duckdb_connection(sf_dir)
    report = {}
    for name in names or list(queries):
        t0 = time.time()
        df = queries[name](spark, sf_dir)
        s_names, s_rows = _rows(df.columns, df.collect())
        t_spark = time.time() - t0
        if name not in sqls:
            report[name] = {"ok": None, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
            if verbose:
                print(f"{name:24s} rows-only  spark_rows={len(s_rows)}  {t_spark:.1f}s", flush=True)
            continue
        res = con.execute(sqls[name])
        o_cols = [d[0] for d in res.description]
        o_names, o_rows = _rows(o_cols, res.fetchall())
        ok = s_names == o_names and s_rows == o_rows
        info = {"ok": ok, "rows": len(s_rows), "oracle_rows": len(o_rows), "spark_s": round(t_spark, 2)}
        if not ok:
            info["spark_cols"], info["oracle_cols"] = s_names, o_names
            diff_s = [r for r in s_rows if r not in set(o_rows)] if len(s_rows) < 200000 else []
            diff_o = [r for r in o_rows if r not in set(s_rows)] if len(o_rows) < 200000 else []
            info["only_spark"] = [repr(r)[:400] for r in diff_s[:3]]
            info["only_oracle"] = [repr(r)[:400] for r in diff_o[:3]]
            info["n_only_spark"], info["n_only_oracle"] = len(diff_s), len(diff_o)
        report[name] = info
        if verbose:
            print(f"{name:24s} {'OK  ' if ok else 'FAIL'} rows={len(s_rows)}/{len(o_rows)} {t_spark:.1f}s",
                  flush=True)
            if not ok:
                for k in ("spark_cols", "oracle_cols", "n_only_spark", "n_only_oracle",
                          "only_spark", "only_oracle"):
                    print(f"    {k}: {info[k]}")
    return report


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tonalyze.session import build_session

    args = sys.argv[1:]
    json_out = None
    if "--json" in args:
        i = args.index("--json")
        json_out = args[i + 1]
        del args[i:i + 2]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", extra={"spark.ui.showConsoleProgress": "false"})
    rep = compare(spark, sf, args[1:] or None)
    bad = [k for k, v in rep.items() if v["ok"] is False]
    print("FAILED:", bad)
    if json_out:
        import json
        with open(json_out, "w") as fh:
            json.dump({"sf_dir": sf, "queries": rep}, fh, indent=1, default=str)
