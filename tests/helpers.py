"""Small helpers shared by the tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

D = dt.date.fromisoformat
OPEN = D("9999-12-31")


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    """Sorted tuples of ``cols`` (NULLs first)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def intervals_ok(hist: DataFrame, key: str = "id") -> None:
    """Invariants of a history: per key, intervals disjoint and ordered, at most
    one current row, ``is_current`` exactly when the interval is open."""
    by = {}
    for r in hist.select(key, "effective_from", "effective_to", "is_current").collect():
        by.setdefault(r[0], []).append((r[1], r[2], r[3]))
    for k, vs in by.items():
        vs.sort()
        assert sum(1 for v in vs if v[2]) <= 1, (k, vs)
        for f, t, cur in vs:
            assert f <= t, (k, vs)
            assert cur == (t == OPEN), (k, vs)
        for (f1, t1, _), (f2, _, _) in zip(vs, vs[1:]):
            assert t1 <= f2, (k, vs)
