"""Compares registered queries with their SQL twins: ``python tests/oracle_check.py [sf] [name prefix ...]``."""

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])


def canonical(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.9g}"
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(norm(i) for i in v) + "]"
        if hasattr(v, "as_tuple"):
            return f"{float(v):.9g}"
        if isinstance(v, int):
            return f"{v:.9g}" if abs(v) < 10**9 else str(v)
        return str(v)

    return sorted([tuple(norm(r[i]) for i in order) for r in rows])


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return None if got else "no rows", len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(got)
    want = canonical(cur.fetchall(), names)
    if got == want:
        return (None, len(got)) if got else ("both empty", 0)
    diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"rows {len(got)} vs {len(want)}; cols {sorted(names)}; {diff}", len(got)


def connect(sf_dir):
    import duckdb

    from lexanchor.fixtures import BASE_TABLES

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


if __name__ == "__main__":
    from lexanchor.session import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    d = f"/root/testdata/sf{sf}"
    spark, con = build_session("check"), connect(d)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            err, n = compare(spark, con, name, fn, sqls.get(name), d)
        except Exception as ex:
            err, n = f"{type(ex).__name__}: {str(ex)[:700]}", 0
        bad += err is not None
        print(f"{'FAIL' if err else 'ok  '} {name} rows={n} {time.time() - t:.1f}s {'' if name in sqls else '(rows only)'} {(err or '')[:1500]}", flush=True)
    print(f"{len(qs)} queries, {bad} bad")
