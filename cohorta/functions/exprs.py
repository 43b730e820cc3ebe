"""Column expressions shared by the operators. Everything here stays inside code generation."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(terms) -> Column:
    return reduce(add, terms)


def z(feature: str) -> str:
    return f"z_{feature}"


def zs(features) -> list[str]:
    return [z(f) for f in features]


def r6(c) -> Column:
    """Six decimals: the resolution at which two engines agree on sums of doubles."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def half_even_2(c) -> Column:
    """Two decimals, half to even. The first rounding removes the last-bit noise of summation order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(F.round(c, 9), 2)


def fixed(c: str, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded on the exact binary value, half to even.

    The built-in formatter rounds the shortest decimal form half up, which moves ties such as 71.55. The fraction is
    therefore cut into two whole numbers of as many bits as a long allows times the power of ten, and a flag for what
    lies below; scaling by powers of two and taking whole parts away are exact.
    """
    ten = 10 ** digits
    bits = 63 - ten.bit_length()
    unit, mask, half = 1 << bits, (1 << bits) - 1, 1 << (bits - 1)
    part = f"(abs({c}) - floor(abs({c})))"
    high = f"CAST({part} * {unit}D AS bigint)"
    rest = f"({part} * {unit}D - CAST({high} AS double))"
    low = f"CAST({rest} * {unit}D AS bigint)"
    below = f"({rest} * {unit}D > CAST({low} AS double))"
    total = f"({high} * {ten}L + shiftright({low} * {ten}L, {bits}))"
    left, last = f"({total} & {mask}L)", f"(({low} * {ten}L) & {mask}L)"
    digit = f"shiftright({total}, {bits})"
    up = (f"CASE WHEN {left} > {half}L OR ({left} = {half}L AND ({last} > 0L OR {below} OR {digit} % 2 = 1)) "
          "THEN 1L ELSE 0L END")
    scaled = f"(CAST(floor(abs({c})) AS bigint) * {ten}L + {digit} + {up})"
    return F.expr(
        f"concat(CASE WHEN {c} < 0 THEN '-' ELSE '' END, CAST({scaled} DIV {ten}L AS string), '.', "
        f"lpad(CAST({scaled} % {ten}L AS string), {digits}, '0'))")


def missing(c: str, dtype: str) -> Column:
    test = F.col(c).isNull()
    return test | F.isnan(F.col(c)) if dtype in ("double", "float") else test


def sq_dist_to(columns, point) -> Column:
    """Squared Euclidean distance from feature columns to one literal point."""
    sides = (f"({c} - {float(v)!r}D)" for c, v in zip(columns, point))
    return F.expr(" + ".join(f"{s} * {s}" for s in sides))


def curve_key(columns, spread: float = 4.0, bits: int = 54) -> Column:
    """Interleaved-bit key that keeps nearby rows near each other in sort order.

    Only the ordering quality depends on it, never a result.
    """
    used = list(columns)[:bits]
    per = max(1, min(8, bits // len(used)))
    top = 1 << per
    cells = [
        f"least({top - 1}L, greatest(0L, floor(({c} + {spread}D) * {top / (2 * spread)}D)))" for c in used
    ]
    marks = [
        f"shiftleft(shiftright({cell}, {level}) & 1L, {level * len(used) + len(used) - 1 - i})"
        for level in range(per) for i, cell in enumerate(cells)
    ]
    return F.expr(" | ".join(marks))


def box_gap2(a: str, b: str, dims: int) -> Column:
    """Smallest possible squared distance between two bounding boxes."""
    gaps = (f"greatest({a}_lo[{i}] - {b}_hi[{i}], {b}_lo[{i}] - {a}_hi[{i}], 0D)" for i in range(dims))
    return F.expr(" + ".join(f"({g}) * ({g})" for g in gaps))


def box_span2(a: str, b: str, dims: int) -> Column:
    """Largest possible squared distance between two bounding boxes."""
    spans = (f"greatest({a}_hi[{i}] - {b}_lo[{i}], {b}_hi[{i}] - {a}_lo[{i}])" for i in range(dims))
    return F.expr(" + ".join(f"({g}) * ({g})" for g in spans))
