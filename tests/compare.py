"""Run registered queries next to their SQL and compare rows and types.

    python tests/compare.py [sf_dir] [name ...]
"""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int", "hugeint": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "flag",
}


def tables(sf_dir):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.6g}" if isinstance(v, float) and v != int(v) else str(int(v))
    return str(v)


def _lines(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(_value(r[i]) for i in order) for r in rows)


def difference(spark, con, name, sf_dir):
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got, names = df.collect(), df.columns
    types = {n: t for n, t in df.dtypes}
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    wanted_names = [d[0] for d in result.description]
    wanted_types = {d[0]: str(d[1]).lower() for d in result.description}
    wanted = result.fetchall()
    if sorted(names) != sorted(wanted_names):
        return f"columns {sorted(names)} <> {sorted(wanted_names)}"
    exact = {"int": "integer", "string": "varchar"}
    kinds = [
        (n, types[n], wanted_types[n]) for n in names
        if exact.get(types[n], types[n]) != wanted_types[n]
    ]
    a, b = _lines(got, names), _lines(wanted, wanted_names)
    if a != b:
        left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"{len(a)} rows <> {len(b)} rows; only here {left[:3]}; only there {right[:3]}; of {sorted(names)}"
    if not a:
        return "both empty"
    return f"types {kinds}" if kinds else None


def main():
    from conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark, con = session(), tables(sf_dir)
    bad = 0
    for name in chosen:
        begun = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begun:.1f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
