"""Compare two results at the precision that they are stated in."""
from __future__ import annotations

import math

REL = 1e-9


def plain(v):
    """A value as both engines can state it."""
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def _key(v):
    """For bringing rows in order: what is exact first, numbers roughly after."""
    if isinstance(v, float) or (isinstance(v, int) and not isinstance(v, bool)):
        return (1, "", float(v))
    return (0, repr(v), 0.0)


def _order(row):
    keys = [_key(v) for v in row]
    return ([k for k in keys if k[0] == 0], [f"{k[2]:.6e}" for k in keys if k[0]], [k[2] for k in keys if k[0]])


def same_value(a, b, rel: float = REL) -> bool:
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return a == b or math.isclose(a, b, rel_tol=rel, abs_tol=rel * 1e-3)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(same_value(x, y, rel) for x, y in zip(a, b, strict=True))
    return a == b


def differences(cols_a, rows_a, cols_b, rows_b, rel: float = REL) -> list[str]:
    """What tells two results apart, in words; empty if nothing does.  Rows
    are a multiset; numbers may differ by ``rel`` of their size, which is
    far below the last place that any query rounds to."""
    if sorted(cols_a) != sorted(cols_b):
        return [f"columns {sorted(cols_a)} and {sorted(cols_b)}"]
    order = sorted(cols_a)
    at_a, at_b = [cols_a.index(c) for c in order], [cols_b.index(c) for c in order]
    a = sorted((tuple(plain(r[i]) for i in at_a) for r in rows_a), key=_order)
    b = sorted((tuple(plain(r[i]) for i in at_b) for r in rows_b), key=_order)
    if len(a) != len(b):
        return [f"{len(a)} rows and {len(b)}"]
    return [f"{x} and {y}" for x, y in zip(a, b, strict=True) if not same_value(x, y, rel)]
