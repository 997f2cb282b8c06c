"""Run registered queries next to their SQL: ``python -m tests.compare [--sf 0.01] [name ...]``.

Rows are compared as bags, after sorting the columns by name; types are compared by family.
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


FAMILY = {"BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint", "VARCHAR": "string",
          "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def compare(spark, con, folder, name, item):
    started = time.time()
    df = item.run(spark, folder)
    rows = df.collect()
    took = time.time() - started
    if item.sql is None:
        return "rows-only" if rows else "EMPTY", len(rows), took, ""
    rel = con.sql(item.sql)
    want = rel.fetchall()
    cols, wcols = df.columns, list(rel.columns)
    if sorted(cols) != sorted(wcols):
        return "COLUMNS", len(rows), took, f"{sorted(cols)} vs {sorted(wcols)}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wtypes = {c: FAMILY.get(str(t), str(t)) for c, t in zip(wcols, rel.types)}
    bad = {c: (types[c], wtypes[c]) for c in cols if types[c] != wtypes[c]}
    if bad:
        return "TYPES", len(rows), took, str(bad)
    order, worder = [cols.index(c) for c in sorted(cols)], [wcols.index(c) for c in sorted(cols)]
    got = Counter(tuple(cell(r[i]) for i in order) for r in rows)
    exp = Counter(tuple(cell(r[i]) for i in worder) for r in want)
    if got != exp:
        extra, lost = list((got - exp).items())[:3], list((exp - got).items())[:3]
        return "ROWS", len(rows), took, f"{len(rows)} vs {len(want)}\n   columns {sorted(cols)}\n   only spark {extra}\n   only sql   {lost}"
    if not rows:
        return "EMPTY", 0, took, ""
    return "ok", len(rows), took, ""


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.001")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from tests.session import local_session
    from tabularium.checks.all import CHECKS
    folder = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), duck(folder)
    picked = {n: c for n, c in CHECKS.items() if not args.names or any(n.startswith(p) for p in args.names)}
    failed = 0
    for name, item in picked.items():
        try:
            status, n, took, note = compare(spark, con, folder, name, item)
        except Exception as exc:  # noqa: BLE001
            status, n, took, note = "ERROR", 0, 0.0, " ".join(str(exc).split())[:700]
        failed += status not in ("ok", "rows-only")
        print(f"{status:10} {name:34} rows={n:<7} {took:6.2f}s {note}", flush=True)
    print(f"{len(picked) - failed}/{len(picked)} fine")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
