"""The public icosahedral hexagon grid of aperture 7 as Column arithmetic: cell ids that other tables can join.

A point is projected from the centre of the earth on the flat face of an icosahedron. On the face it has coordinates (i, j) of a
hexagonal lattice whose vertices of the face lie two steps from its centre; every finer level has cells a seventh as large, and
odd levels are turned. Rounding to the nearest cell, then to the parent of each cell up to level 0, gives one of 122 base cells
and a digit for every level, which are packed in one BIGINT (4 bits of kind, 3 free, 4 of level, 7 of base cell, 3 of each digit; 7 below the level).

Everything that depends on the shape of the icosahedron is derived here from two fixed lists (faces, base cells), in plain Python
once per process: corners, neighbours of faces, and for each lattice place of a face its base cell and by how many sixths of a
turn the face's digits differ from that cell's own. In Columns there are then only integer steps, and three-by-three
products at either end, all of it in generated code (:class:`Steps`).

``place`` is a cell as (face, i, j) in one BIGINT, the form in which rings are sums: neighbours are constant offsets, turned
over where they leave the face. Twelve cells of each level, at the corners, are pentagons; see :func:`near_corner`.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the public grid: latitude and longitude of the centre of each face, and the azimuth from there to its first
# corner, in radians.
FACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882), (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055), (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400), (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874), (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154), (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562), (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361), (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535), (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316), (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436), (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)
# Fixed values of the public grid: face and lattice place "ijk" at which each base cell has its own digits. They are in order of
# latitude, from north to south; those at a corner (a place with a 2) are pentagons.
BASE_CELLS = (
    "1:100 2:110 1:000 2:100 0:200 1:110 1:001 2:000 0:100 2:010 1:010 1:011 3:100 3:110 11:200 4:100 0:000 6:010 0:001 2:011 "
    "7:001 2:001 0:110 6:001 10:200 6:000 3:000 11:100 4:110 3:010 0:011 4:000 5:010 0:010 7:010 11:110 7:000 10:100 12:200 6:101 "
    "7:101 4:001 3:001 3:011 4:010 6:100 11:000 8:001 5:001 14:200 5:000 12:100 10:110 4:011 12:110 7:100 11:010 10:000 13:200 10:001 "
    "11:001 9:010 8:010 6:200 8:000 9:001 14:100 5:101 16:011 8:101 5:100 12:000 7:200 12:010 10:010 9:000 13:100 16:001 15:011 15:010 "
    "16:010 14:110 13:110 5:200 8:100 14:000 9:101 14:001 17:001 12:001 16:000 17:011 15:001 16:101 9:100 15:000 13:000 8:200 13:010 17:101 "
    "19:010 14:010 19:011 17:010 13:001 17:000 16:100 9:200 15:101 15:100 18:011 18:001 19:001 17:100 19:000 18:010 18:101 19:200 19:100 18:000 "
    "19:101 18:100"
)
#: Digits: 0 the middle, then the sums of 4 (i), 2 (j) and 1 (k) of a step. A sixth of a turn to the left changes them like this.
LEFT = {0: 0, 1: 5, 5: 4, 4: 6, 6: 2, 2: 3, 3: 1}
K, JK, IK = 1, 3, 5
MAX_LEVEL = 15

Vector = tuple[float, float, float]


def _unit(v: Vector) -> Vector:
    n = math.sqrt(sum(x * x for x in v))
    return (v[0] / n, v[1] / n, v[2] / n)


def _dot(a: Vector, b: Vector) -> float:
    return sum(x * y for x, y in zip(a, b, strict=True))


def _cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def _mix(weights: tuple[float, ...], vectors: tuple[Vector, ...]) -> Vector:
    return tuple(sum(w * v[i] for w, v in zip(weights, vectors, strict=True)) for i in range(3))


def _sphere(lat: float, lon: float) -> Vector:
    return (math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat))


def turn(i: int, j: int, sixths: int) -> tuple[int, int]:
    """The lattice step (i, j) after some sixths of a turn to the left."""
    for _ in range(sixths % 6):
        i, j = i - j, i
    return i, j


def axial(ijk: tuple[int, int, int]) -> tuple[int, int]:
    return ijk[0] - ijk[2], ijk[1] - ijk[2]


def weights_of(x: float, y: float) -> Vector:
    """Shares of the three corners in a place, in lattice steps of level 0."""
    k = (1 - (x + y) / 2) / 3
    return (k + x / 2, k + y / 2, k)


def finer(x, y, level: int):
    """Lattice steps of level 0 in steps of ``level``: numbers or Columns."""
    s = 7 ** (level // 2)
    return (s * (2 * x + y), s * (3 * y - x)) if level % 2 else (s * x, s * y)


@dataclass(frozen=True)
class Shape:
    """What follows from the fixed lists."""

    corners: tuple[Vector, ...]  # the twelve corners
    faces: tuple[tuple[int, int, int], ...]  # corner numbers of the i, j and k axis of each face
    duals: tuple[tuple[Vector, Vector, Vector], ...]  # products with a point that give its corner weights
    across: dict[tuple[int, int], tuple[int, int, tuple[int, int]]]  # (face, axis): behind the side opposite to that corner, the other face, turn and shift
    homes: tuple[tuple[int, tuple[int, int]], ...]  # face and place (i, j) of each base cell
    pentagons: frozenset[int]
    base: dict[tuple[int, int, int], tuple[int, int]]  # (face, i, j): base cell and kind of turn
    turns: dict[tuple[int, int], int]  # (kind, first digit that is not 0): sixths of a turn
    round_corner: dict[int, tuple[tuple[int, int], ...]]  # of each pentagon: faces to the right around it, and their turn against home

    def point(self, face: int, x: float, y: float) -> Vector:
        """On the sphere, of a place in level 0 steps, on or near the face."""
        return _unit(_mix(weights_of(x, y), tuple(self.corners[c] for c in self.faces[face])))


@cache
def shape() -> Shape:
    """The icosahedron of the fixed lists."""
    corners: list[Vector] = []
    faces = []
    # Angle between the centre of a face and its corners: the centre is a third of the corners' sum.
    reach = math.acos(math.sqrt((5 + 2 * math.sqrt(5)) / 15))
    for lat, lon, first in FACES:
        centre, own = _sphere(lat, lon), []
        north, east = (-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat)), (-math.sin(lon), math.cos(lon), 0.0)
        for n in range(3):
            az = first - n * 2 * math.pi / 3  # azimuths run to the right, the axes to the left
            corner = _mix((math.cos(reach), math.sin(reach) * math.cos(az), math.sin(reach) * math.sin(az)), (centre, north, east))
            known = [m for m, c in enumerate(corners) if _dot(c, corner) > 1 - 1e-9]
            if not known:
                corners.append(_unit(corner))
            own.append(known[0] if known else len(corners) - 1)
        faces.append(tuple(own))
    vectors = [tuple(corners[c] for c in own) for own in faces]
    duals = []
    for a, b, c in vectors:
        volume = _dot(a, _cross(b, c))
        duals.append(tuple(tuple(x / volume for x in _cross(*two)) for two in ((b, c), (c, a), (a, b))))

    across = {}
    at_corner = [(2, 0), (0, 2), (-2, -2)]  # places of the corners
    for f, own in enumerate(faces):
        for axis in range(3):
            a, b = own[(axis + 1) % 3], own[(axis + 2) % 3]
            other = next(g for g in range(len(faces)) if g != f and {a, b} <= {*faces[g]})
            # Both corners of the side fix turn and shift.
            (ai, aj), (bi, bj) = at_corner[(axis + 1) % 3], at_corner[(axis + 2) % 3]
            (ci, cj), (di, dj) = (at_corner[faces[other].index(x)] for x in (a, b))
            sixths = next(n for n in range(6) if turn(bi - ai, bj - aj, n) == (di - ci, dj - cj))
            ti, tj = turn(ai, aj, sixths)
            across[f, axis] = other, sixths, (ci - ti, cj - tj)

    homes = []
    for text in BASE_CELLS.split():
        face, ijk = text.split(":")
        homes.append((int(face), axial(tuple(map(int, ijk)))))
    pentagons = frozenset(n for n, text in enumerate(BASE_CELLS.split()) if "2" in text.split(":")[1])
    made = Shape(tuple(corners), tuple(faces), tuple(duals), across, tuple(homes), pentagons, {}, {}, {})

    centres = [made.point(f, *ij) for f, ij in homes]
    # Around a pentagon: faces to the right of home, and the turn from the digits of each to those of home.
    for cell in pentagons:
        corner, (face, total), ring = faces[homes[cell][0]][0], (homes[cell][0], 0), []
        for _ in range(5):
            ring.append((face, total % 6))
            # To the right lies the side to the next corner, opposite to the one after it.
            axis = (faces[face].index(corner) + 2) % 3
            face, sixths, _ = across[face, axis]
            total -= sixths
        made.round_corner[cell] = tuple(ring)

    for f in range(len(faces)):
        for ijk in ((i, j, k) for i in range(3) for j in range(3) for k in range(3) if 0 in (i, j, k)):
            place = axial(ijk)
            face, (i, j), total = f, place, 0
            for _ in range(2):  # a place outside lies behind one side, at most two near a corner
                w = weights_of(i, j)
                if min(w) >= -1e-9:
                    break
                face, sixths, (si, sj) = across[face, w.index(min(w))]
                i, j = turn(i, j, sixths)
                i, j, total = i + si, j + sj, total + sixths
            here = made.point(face, i, j)
            cell = max(range(len(centres)), key=lambda c: _dot(centres[c], here))
            home, _ = homes[cell]
            if cell in pentagons:
                around = [g for g, _ in made.round_corner[cell]]
                last = 6 * (around.index(face) == 4)
                made.base[f, *place] = cell, 6 + last + made.round_corner[cell][around.index(face)][1]
                continue
            # At most one side lies between this face and home.
            back = 0 if face == home else next(across[face, a][1] for a in range(3) if across[face, a][0] == home)
            made.base[f, *place] = cell, (total + back) % 6
    for kind in range(18):
        for first in range(7):
            made.turns[kind, first] = _turns(kind, first)
    return made


def _turns(kind: int, first: int) -> int:
    """Sixths of a turn for the digits of a base cell whose first digit that is not 0 is ``first``.

    Kinds 6 to 17 are of pentagons, which have no cells behind digit K: what lies there from the first face continues to the
    left, from the last one around the corner (kinds of 12 and more) to the right.
    """
    sixths, digit = kind % 6, first
    for _ in range(sixths):
        digit = LEFT[digit]
    if kind < 6 or digit != K:
        return sixths
    return (sixths + (1 if kind < 12 else -1)) % 6


# --- Columns ---------------------------------------------------------------------------------------------------------------

#: Lattice steps of the digits.
STEPS = {0: (0, 0), 1: (-1, -1), 2: (0, 1), 3: (-1, 0), 4: (1, 0), 5: (0, -1), 6: (1, 1)}
# A place is face, i and j; both coordinates are shifted to be positive.
_J, _I, _ZERO = 1, 1 << 27, 1 << 26
_FACE = 1 << 54


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _array(values, kind: str = "bigint") -> Column:
    """A constant array. It is written as one text, which the optimiser turns into a literal: a node instead of hundreds."""
    return F.expr(f"cast(split('{','.join(map(repr, values))}', ',') as array<{kind}>)")


def _pack(face: int, i: int, j: int) -> int:
    return face * _FACE + (i + _ZERO) * _I + (j + _ZERO)


def pack_place(face: Column, i: Column, j: Column) -> Column:
    return face.cast("bigint") * _FACE + (i.cast("bigint") + _ZERO) * _I + (j.cast("bigint") + _ZERO)


def _unpacked(place: Column) -> tuple[Column, Column, Column]:
    return F.shiftright(place, 54), F.shiftright(place, 27).bitwiseAND(_I - 1) - _ZERO, place.bitwiseAND(_I - 1) - _ZERO


def _down(level: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """Rows of the product that makes steps of a level from those of the level above."""
    return ((2, 1), (-1, 3)) if level % 2 else ((3, -1), (1, 2))


def _size(level: int) -> int:
    """Steps of ``_aligned`` in one step of level 0."""
    return 7 ** ((level + 1) // 2)


def _aligned(i, j, level: int):
    """Lattice steps turned to the axes of level 0, in ``_size(level)`` parts of its steps."""
    return (3 * i - j, i + 2 * j) if level % 2 else (i, j)


def _weights(i, j, level: int):
    """Corner weights of a place, times six times ``_size``: none is negative inside the face."""
    x, y = _aligned(i, j, level)
    s = _size(level)
    return 2 * s + 2 * x - y, 2 * s - x + 2 * y, 2 * s - x - y


def _check_level(level: int) -> None:
    if not 0 <= level <= MAX_LEVEL:
        raise ValueError(f"levels are 0 to {MAX_LEVEL}")


class Steps:
    """Values that are computed once: each becomes a column of a projection of its own, inside the same generated code.

    ``let`` does the same inside one Column, but is interpreted, and takes long to plan where it is nested deeply. A filter or
    an inner join on a result is planned through all its steps, each with a copy of the ones before: write such a frame
    (``operators.staging``) before filtering or joining on its cells.
    """

    def __init__(self) -> None:
        self.made: list[dict[str, Column]] = []

    def bind(self, *values: Column) -> list[Column]:
        """Columns that hold the values; values bound together may not use each other."""
        names = [f"_g{sum(map(len, self.made)) + n}" for n in range(len(values))]
        self.made.append(dict(zip(names, values, strict=True)))
        return [F.col(n) for n in names]

    def add(self, df: DataFrame, **out: Column) -> DataFrame:
        """``df`` with the columns ``out``, which may use what is bound; the rest goes."""
        for columns in self.made:
            df = df.withColumns(columns)
        return df.withColumns(out).drop(*[n for columns in self.made for n in columns])


def _place_of(at: Steps, lat: Column, lon: Column, level: int) -> Column:
    """Place of the cell that contains a point in degrees; NULL for a missing coordinate."""
    _check_level(level)
    made = shape()
    centres = [_sphere(la, lo) for la, lo, _ in FACES]
    duals = _array([x for own in made.duals for v in own for x in v], "double")
    la, lo = at.bind(F.radians(lat), F.radians(lon))
    p = at.bind(F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))
    (near,) = at.bind(F.array(*[p[0] * x + p[1] * y + p[2] * z for x, y, z in centres]))
    (face,) = at.bind((F.array_position(near, F.array_max(near)) - 1).cast("int"))
    a, b, c = at.bind(*[sum((F.get(duals, face * 9 + (3 * n + x)) * p[x] for x in range(3)), F.lit(0.0)) for n in range(3)])
    x, y = at.bind(2 * (a - c) / (a + b + c), 2 * (b - c) / (a + b + c))
    u, v = at.bind(*finer(x, y, level))
    # Three coordinates whose sum is 0; the one that was rounded most follows from the others.
    a, b, c = at.bind(*[F.floor(x + 0.5) for x in (u, -v, v - u)])
    da, db, dc = at.bind(F.abs(a - u), F.abs(b + v), F.abs(c - (v - u)))
    first = (da > db) & (da > dc)
    i, j = at.bind(F.when(first, -b - c).otherwise(a), F.when(~first & (db > dc), a + c).otherwise(-b))
    return at.bind(pack_place(face, i, j))[0]


def _id_of(at: Steps, place: Column, level: int) -> Column:
    """The public id of a place."""
    _check_level(level)
    made = shape()
    base = [0] * 500
    for (face, i, j), (cell, kind) in made.base.items():
        base[face * 25 + (i + 2) * 5 + j + 2] = cell * 32 + kind
    turns = _array([made.turns[kind, first] for kind in range(18) for first in range(7)], "int")
    turned = []
    for sixths in range(6):
        digits = range(7)
        for _ in range(sixths):
            digits = [LEFT[d] for d in digits]
        turned += digits
    face, i, j = at.bind(*_unpacked(place))
    own: list[Column] = []
    for r in range(level, 0, -1):
        (p, q), (s, t) = _down(r + 1)  # times seven, the way back
        up = at.bind(F.floor((i * p + j * q + 3) / 7), F.floor((i * s + j * t + 3) / 7))
        (a, b), (c, d) = _down(r)
        di, dj = at.bind(i - up[0] * a - up[1] * b, j - up[0] * c - up[1] * d)
        own += at.bind((di * 4 + dj * 2 - F.least(di, dj, F.lit(0).cast("bigint")) * 7).cast("int"))
        i, j = up
    own.reverse()
    first = F.coalesce(*[F.when(d != 0, d) for d in own], F.lit(0))
    (entry,) = at.bind(F.get(_array(base, "int"), (face * 25 + (i + 2) * 5 + j + 2).cast("int")))
    (sixths,) = at.bind(F.get(turns, entry.bitwiseAND(31) * 7 + first))
    rotated = _array(turned)
    parts = [F.get(rotated, sixths * 7 + d) * (8 ** (MAX_LEVEL - r)) for r, d in enumerate(own, 1)]
    fixed = (1 << 59) + (level << 52) + 8 ** (MAX_LEVEL - level) - 1
    return sum(parts, F.shiftright(entry, 5).cast("bigint") * (1 << 45)) + fixed


def with_cells(df: DataFrame, lat: Column, lon: Column, levels: Mapping[str, int]) -> DataFrame:
    """``df`` with the public id of the cell of a point in degrees, at each level, in the columns named."""
    for name, level in levels.items():
        at = Steps()
        df = at.add(df, **{name: _id_of(at, _place_of(at, lat, lon, level), level)})
    return df


def with_ids(df: DataFrame, place: str, out: str, level: int) -> DataFrame:
    """``df`` with the ids of places."""
    at = Steps()
    return at.add(df, **{out: _id_of(at, F.col(place), level)})


def with_places(df: DataFrame, cell: str, out: str, level: int) -> DataFrame:
    """``df`` with the settled places of cells of ``level``: equal cells have equal places."""
    at = Steps()
    return at.add(df, **{out: _place_of_cell(at, F.col(cell), level)})


def level_of(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(15).cast("int")


def cell_text(cell: Column) -> Column:
    """The id as it is written: lower-case hexadecimal digits."""
    return F.lower(F.hex(cell))


def parent_cell(cell: Column, level: int) -> Column:
    """The cell of a coarser level whose digits begin the cell's own; NULL if the cell is coarser than ``level``."""
    _check_level(level)
    below = 8 ** (MAX_LEVEL - level) - 1
    rest = cell.bitwiseAND(~(below | (15 << 52))).bitwiseOR(F.lit(below | (level << 52)))
    return F.when(level_of(cell) >= level, rest)


def _place_of_cell(at: Steps, cell: Column, level: int) -> Column:
    _check_level(level)
    made = shape()
    (base,) = at.bind(F.shiftright(cell, 45).bitwiseAND(127).cast("int"))
    digits = at.bind(*[F.shiftright(cell, 3 * (MAX_LEVEL - r)).bitwiseAND(7).cast("int") for r in range(1, level + 1)]) if level else []
    i = F.get(_array([finer(*ij, level)[0] for _, ij in made.homes]), base)
    j = F.get(_array([finer(*ij, level)[1] for _, ij in made.homes]), base)
    for r, digit in enumerate(digits, 1):
        steps = []
        for d in range(7):
            x, y = STEPS[d]
            for below in range(r + 1, level + 1):
                (a, b), (c, e) = _down(below)
                x, y = a * x + b * y, c * x + e * y
            steps.append((x, y))
        i, j = i + F.get(_array([x for x, _ in steps]), digit), j + F.get(_array([y for _, y in steps]), digit)
    i, j = at.bind(i, j)
    first = F.coalesce(*[F.when(d != 0, d) for d in digits], F.lit(0)) if digits else F.lit(0)
    five = F.get(_array([int(n in made.pentagons) for n in range(len(made.homes))], "int"), base) == 1
    home = F.get(_array([f for f, _ in made.homes], "int"), base)
    (place,) = at.bind(F.when(five, _unfolded(at, base, i, j, first, level)).otherwise(pack_place(home, i, j)))
    for _ in range(2):
        (place,) = at.bind(settle(place, level))
    return place


def _unfolded(at: Steps, base: Column, i: Column, j: Column, first: Column, level: int) -> Column:
    """Place of a cell of a pentagon: its faces follow each other to the right around the corner, each a sixth of a turn on."""
    made = shape()
    ci, cj = finer(2, 0, level)
    around: list[int] = [0] * (len(made.homes) * 5)
    axis_of: list[int] = [0] * (len(made.homes) * 5)
    for cell in made.pentagons:
        home, _ = made.homes[cell]
        for m, (face, _) in enumerate(made.round_corner[cell]):
            around[cell * 5 + m], axis_of[cell * 5 + m] = face, made.faces[face].index(made.faces[home][0])
    di, dj = i - ci, j - cj
    # The sixths of a turn after which the step from the corner lies between the sides of home.
    sector = F.lit(5)
    for m in range(4, -1, -1):
        (a, b), (c, d) = turn(1, 0, m), turn(0, 1, m)
        u, v = _aligned(di * a + dj * c, di * b + dj * d, level)
        sector = F.when((2 * v - u >= 0) & (u + v <= 0), F.lit(m)).otherwise(sector)
    (m,) = at.bind(sector)
    # Behind digit K of a pentagon is nothing: there, the first and the last face continue.
    n = F.when(m < 5, m).when(first == JK, F.lit(4)).otherwise(F.lit(0))
    (index,) = at.bind(base * 5 + n)
    ti, tj = at.bind(*_turned(di, dj, m))
    ti, tj = _turned(ti + ci, tj + cj, 2 * F.get(_array(axis_of, "int"), index))
    return pack_place(F.get(_array(around, "int"), index), ti, tj)


def _turned(i: Column, j: Column, sixths: Column) -> tuple[Column, Column]:
    """:func:`turn` by a Column of sixths, 0 to 11."""
    rows = [turn(1, 0, n) + turn(0, 1, n) for n in range(12)]
    a, b, c, d = (F.get(_array([r[x] for r in rows]), sixths) for x in range(4))
    return i * a + j * c, i * b + j * d


def settle(place: Column, level: int) -> Column:
    """The place on the face where it lies, if at most one side is between; of faces that share it, on the first.

    A place that comes over a side may lie on another one, so a second call may change it once more.
    """
    made = shape()
    face, i, j = _unpacked(place)
    w = _weights(i, j, level)
    others, sixths, si, sj, corners = [], [], [], [], []
    for f, own in enumerate(made.faces):
        for axis in range(3):
            other, n, shift = made.across[f, axis]
            others.append(other)
            sixths.append(n)
            x, y = finer(*shift, level)
            si.append(x)
            sj.append(y)
            corners.append(corner_place(own[axis], level))
    side = [F.get(_array(others, "int"), (face * 3 + n).cast("int")) for n in range(3)]
    leaves = [(w[n] < 0) | ((w[n] == 0) & (side[n] < face)) for n in range(3)]
    axis = F.when(leaves[0], F.lit(0)).when(leaves[1], F.lit(1)).otherwise(F.lit(2))
    index = (face * 3 + axis).cast("int")
    ti, tj = _turned(i, j, F.get(_array(sixths, "int"), index))
    over = pack_place(F.get(_array(others, "int"), index), ti + F.get(_array(si), index), tj + F.get(_array(sj), index))
    made_corners = _array(corners)
    at = [F.when((w[(n + 1) % 3] == 0) & (w[(n + 2) % 3] == 0), F.get(made_corners, (face * 3 + n).cast("int"))) for n in range(3)]
    return F.coalesce(*at, F.when(leaves[0] | leaves[1] | leaves[2], over).otherwise(place))


def settled(place: Column, level: int) -> Column:
    """:func:`settle` until nothing changes."""
    return let(place, lambda p: let(settle(p, level), lambda q: settle(q, level)))


def corner_place(corner: int, level: int) -> int:
    """The settled place of a corner: on its first face."""
    made = shape()
    face = min(f for f, own in enumerate(made.faces) if corner in own)
    return _pack(face, *finer(*turn(2, 0, 2 * made.faces[face].index(corner)), level))


def near_corner(place: Column, k: int, level: int) -> Column:
    """Whether a corner is within ``k`` steps, so that :func:`ring_steps` would be wrong there."""
    face, i, j = _unpacked(place)
    near = []
    for axis in range(3):
        ci, cj = finer(*turn(2, 0, 2 * axis), level)
        near.append(F.greatest(F.abs(i - ci), F.abs(j - cj), F.abs((i - ci) - (j - cj))) <= k)
    return near[0] | near[1] | near[2]


def ring_offsets(k: int) -> list[tuple[int, int, int]]:
    """(di, dj, ring) of the 1 + 3k(k+1) places at distance <= k."""
    far = range(-k, k + 1)
    return [(i, j, max(abs(i), abs(j), abs(i - j))) for i in far for j in far if abs(i - j) <= k]


def ring_steps(k: int) -> Column:
    """Literal ARRAY<STRUCT<step, ring>>: what to add to a place, and then to settle twice."""
    return F.expr("array(%s)" % ", ".join(f"named_struct('step', {i * _I + j}L, 'ring', {ring})" for i, j, ring in ring_offsets(k)))


def neighbours(place: Column, level: int) -> Column:
    """Settled places of the six neighbours, of a pentagon five."""
    made = shape()
    own = []
    for corner in range(len(made.corners)):
        here = []
        for f, three in enumerate(made.faces):
            if corner in three:
                ci, cj = finer(*turn(2, 0, 2 * three.index(corner)), level)
                for d in range(1, 7):
                    i, j = ci + STEPS[d][0], cj + STEPS[d][1]
                    if min(_weights(i, j, level)) >= 0:
                        here.append(_pack(f, i, j))
        own.append((corner_place(corner, level), here))
    known = F.expr("map(%s)" % ", ".join(f"{p}L, array({', '.join(f'{x}L' for x in here)})" for p, here in own))
    steps = _array([i * _I + j for i, j, ring in ring_offsets(1) if ring])

    reached = F.coalesce(F.try_element_at(known, place), F.transform(steps, lambda s: place + s))
    return F.array_distinct(F.transform(reached, lambda p: settled(p, level)))


def rings_by_steps(place: Column, k: int, level: int) -> Column:
    """ARRAY<STRUCT<place, ring>> of the cells within ``k`` steps, found step by step: right near corners too."""
    grown = F.transform(F.array(place), lambda p: F.struct(p.alias("place"), F.lit(0).alias("ring")))
    start = F.struct(F.array(place).alias("edge"), F.array(place).alias("seen"), grown.alias("found"))

    def step(acc: Column, ring: Column) -> Column:
        reached = F.array_except(F.array_distinct(F.flatten(F.transform(acc["edge"], lambda p: neighbours(p, level)))), acc["seen"])
        return let(reached, lambda new: F.struct(
            new.alias("edge"), F.concat(acc["seen"], new).alias("seen"),
            F.concat(acc["found"], F.transform(new, lambda p: F.struct(p.alias("place"), ring.alias("ring")))).alias("found"),
        ))

    if not k:
        return grown
    return F.aggregate(F.sequence(F.lit(1), F.lit(k)), start, step)["found"]


def centre(place: Column, level: int) -> Column:
    """STRUCT<lat, lon> in degrees of the middle of a place."""
    made = shape()
    flat = _array([x for own in made.faces for c in own for x in made.corners[c]], "double")
    face, i, j = _unpacked(place)
    w = [x.cast("double") for x in _weights(i, j, level)]

    def middle(x: Column) -> Column:
        at = [sum((x[f"w{n}"] * F.get(flat, x["face"] * 9 + (3 * n + c)) for n in range(3)), F.lit(0.0)) for c in range(3)]
        return let(F.struct(*[a.alias(n) for a, n in zip(at, "xyz", strict=True)]), lambda p: F.struct(
            F.degrees(F.atan2(p["z"], F.sqrt(p["x"] * p["x"] + p["y"] * p["y"]))).alias("lat"), F.degrees(F.atan2(p["y"], p["x"])).alias("lon"),
        ))

    return F.when(place.isNotNull(), let(F.struct(face.cast("int").alias("face"), *[x.alias(f"w{n}") for n, x in enumerate(w)]), middle))
