"""Compare registered queries with their SQL: python tests/oracle.py [sf] [name ...]"""

from __future__ import annotations

import importlib.util
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    return str(value)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """(ok, message, seconds)"""
    started = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    columns, got = normalise(df.columns, rows)
    if sql is None:
        return True, f"rows only, {len(got)} rows", seconds
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    wanted_columns, wanted = normalise(names, answer.fetchall())
    if columns != wanted_columns:
        return False, f"columns {columns} against {wanted_columns}", seconds
    if got != wanted:
        extra = [r for r in got if r not in set(wanted)][:3]
        missing = [r for r in wanted if r not in set(got)][:3]
        return False, f"{len(got)} rows against {len(wanted)}; extra {extra}; missing {missing}", seconds
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(c, types[c], kinds[c]) for c in columns if pairs.get(types[c], "") != kinds[c]]
    return True, f"{len(got)} rows" + (f"; types differ: {odd}" if odd else ""), seconds


if __name__ == "__main__":
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    entry = load_entry()
    spark = local_session(8, "oracle")
    con = duck(f"{DATA}/sf{sf}")
    oracle = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and not any(name == p or (p.endswith("*") and name.startswith(p[:-1])) for p in sys.argv[2:]):
            continue
        try:
            ok, message, seconds = compare(spark, con, f"{DATA}/sf{sf}", query, oracle.get(name))
        except Exception as error:  # report and go on with the next query
            ok, message, seconds = False, f"{type(error).__name__}: {str(error)[:900]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {seconds:6.2f}s {message}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
