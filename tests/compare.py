"""Rows of the two engines as sorted plain values."""

from __future__ import annotations

import decimal
import math


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def check(spark, sf, duck, make, sql):
    df = make(spark, sf)
    found = duck.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.collect(), df.columns) == rows_of(found.fetchall(), columns)
