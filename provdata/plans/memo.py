"""Per-session memo of intermediate DataFrames shared by several queries.

A DataFrame is an immutable plan, so reusing one object across queries is
safe; it only saves re-parsing and re-analysing the same sub-plan on the
driver (each Column built in Python is a round trip to the JVM).
"""

from __future__ import annotations

import functools

_MEMO: dict = {}


def per_session(fn):
    @functools.wraps(fn)
    def wrapper(spark, sf, *args):
        key = (fn.__module__, fn.__qualname__, id(spark), sf, args)
        hit = _MEMO.get(key)
        if hit is None or hit[0] is not spark:
            hit = (spark, fn(spark, sf, *args))
            _MEMO[key] = hit
        return hit[1]
    return wrapper
