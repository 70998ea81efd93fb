"""Run a Spark query and its SQL check, and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def duckdb_rows(sql: str, folder: str):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def differences(left, right, limit: int = 3) -> list[str]:
    (ln, lr), (rn, rr) = left, right
    if ln != rn:
        return [f"columns {ln} != {rn}"]
    if len(lr) != len(rr):
        return [f"{len(lr)} rows != {len(rr)} rows"]
    found = []
    for a, b in zip(sorted(lr, key=_key), sorted(rr, key=_key)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            found.append(f"{a} != {b}")
            if len(found) == limit:
                break
    return found
