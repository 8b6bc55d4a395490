"""Run registered queries next to their SQL: python tests/compare.py [sf] [name ...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return repr(float(value)) if isinstance(value, int) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_names, spark_rows, sql_names, sql_rows):
    """None if equal, else a short account."""
    if sorted(spark_names) != sorted(sql_names):
        return f"columns {sorted(spark_names)} / {sorted(sql_names)}"
    left, right = rows_of(spark_names, spark_rows), rows_of(sql_names, sql_rows)
    if left == right:
        return None
    only = [r for r in left if r not in set(right)][:3], [r for r in right if r not in set(left)][:3]
    return f"{len(left)} / {len(right)} rows\n  spark {only[0]}\n  sql   {only[1]}"


def main():
    import __spark_entry__ as entry
    from catalogia.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name}: {len(rows)} ({took:.1f}s)", flush=True)
                continue
            cursor = con.execute(oracles[name])
            sql_rows = cursor.fetchall()
            diff = difference(df.columns, rows, [d[0] for d in cursor.description], sql_rows)
        except Exception as error:
            diff, took, rows = str(error)[:1500], time.time() - start, []
        if diff:
            bad.append(name)
        print(f"{'DIFF' if diff else 'same'}  {name}: {len(rows)} ({took:.1f}s) {diff or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
