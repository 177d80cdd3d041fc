"""A planar hexagonal grid in Column arithmetic.

Spark has no hexagonal index, so cells are axial coordinates (q, r) of a
pointy-top grid on an equirectangular plane, packed into one BIGINT. Cell ids
are therefore not compatible with any public geo index; ring distances,
neighbourhoods and parent roll-ups behave alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.8
# Edge of a level-9 cell in metres; each coarser level has cells 7 times as large.
LEVEL9_EDGE_M = 200.0
_SHIFT = 1 << 30
_SPAN = 1 << 31
_M_PER_DEG = EARTH_M * math.pi / 180.0


def edge_m(level: int) -> float:
    return LEVEL9_EDGE_M * 7.0 ** ((9 - level) / 2.0)


def pack(q: Column, r: Column) -> Column:
    return (q.cast("bigint") + F.lit(_SHIFT)) * F.lit(_SPAN) + (r.cast("bigint") + F.lit(_SHIFT))


def axial_q(cell: Column) -> Column:
    return F.shiftright(cell, 31) - F.lit(_SHIFT)


def axial_r(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(_SPAN - 1)) - F.lit(_SHIFT)


def cell_text(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def _half_up(x: Column) -> Column:
    return F.floor(x + F.lit(0.5))


def cell_of(lat: Column, lon: Column, level: int = 9) -> Column:
    """Cell containing a point (cube rounding of fractional axial coordinates)."""
    size = edge_m(level)
    x = lon * F.lit(_M_PER_DEG) / F.lit(size)
    y = lat * F.lit(_M_PER_DEG) / F.lit(size)
    q = x * F.lit(math.sqrt(3.0) / 3.0) - y / F.lit(3.0)
    r = y * F.lit(2.0) / F.lit(3.0)
    s = -q - r
    rq, rr, rs = _half_up(q), _half_up(r), _half_up(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    cq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    cr = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return pack(cq, cr)


def centre_lat(cell: Column, level: int = 9) -> Column:
    return F.lit(edge_m(level) * 1.5 / _M_PER_DEG) * axial_r(cell)


def centre_lon(cell: Column, level: int = 9) -> Column:
    size = edge_m(level)
    return F.lit(size * math.sqrt(3.0) / _M_PER_DEG) * (axial_q(cell) + axial_r(cell) / F.lit(2.0))


def parent_cell(cell: Column, level: int) -> Column:
    """Cell of a coarser level that contains the centre of a level-9 cell."""
    return cell_of(centre_lat(cell), centre_lon(cell), level)


def ring_offsets(k: int) -> list[tuple[int, int, int]]:
    """(dq, dr, ring) of the 1 + 3k(k+1) cells at distance <= k."""
    out = []
    for dq in range(-k, k + 1):
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1):
            out.append((dq, dr, (abs(dq) + abs(dr) + abs(dq + dr)) // 2))
    return out


def ring_steps(k: int) -> Column:
    """Literal ARRAY<STRUCT<step, ring>>: what to add to a cell to reach each cell within k steps.

    Exploding this literal and adding stays inside generated code, unlike a lambda
    over an array. It is one parsed expression, as building 91 structs call by
    call is slow on the driver.
    """
    steps = ", ".join(f"named_struct('step', {dq * _SPAN + dr}L, 'ring', {ring})" for dq, dr, ring in ring_offsets(k))
    return F.expr(f"array({steps})")


def ring_distance(a: Column, b: Column) -> Column:
    dq = axial_q(a) - axial_q(b)
    dr = axial_r(a) - axial_r(b)
    return ((F.abs(dq) + F.abs(dr) + F.abs(dq + dr)) / F.lit(2)).cast("int")


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle (haversine) distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = p2 - p1, F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dp / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), F.lit(2.0))
    return F.lit(2.0 * EARTH_M) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))
