"""Vector, matrix and rotation arithmetic as unrolled Column expressions.

A point is ``struct<x, y, z>``; a 3x3 or 4x4 matrix is a flat row-major ``array<double>``. Unrolled
arithmetic stays inside whole-stage code generation, which higher-order array functions do not.
Chains of matrix products should go through ``withColumn`` step by step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
QUAT = ("qx", "qy", "qz", "qw")


def _built(column: Column, cells) -> Column:
    """Remember the components a struct or matrix column was built from, so that taking one of
    them again does not repeat the whole constructor."""
    column.__dict__["_cells"] = tuple(cells)
    return column


def _cells(column) -> tuple | None:
    return column.__dict__.get("_cells") if isinstance(column, Column) else None


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(float(v))


# ------------------------------------------------------------------ points

def vec(x, y, z) -> Column:
    x, y, z = _c(x), _c(y), _c(z)
    return _built(F.struct(x.alias("x"), y.alias("y"), z.alias("z")), (x, y, z))


def xyz(v) -> tuple[Column, Column, Column]:
    if _cells(v):
        return _cells(v)
    v = _c(v)
    return v["x"], v["y"], v["z"]


def from_array(a) -> Column:
    """Point from a 3-element array; NULL stays NULL."""
    a = _c(a)
    return F.when(a.isNotNull(), vec(a[0], a[1], a[2]))


def add(a, b) -> Column:
    return vec(*[p + q for p, q in zip(xyz(a), xyz(b))])


def sub(a, b) -> Column:
    return vec(*[p - q for p, q in zip(xyz(a), xyz(b))])


def times(v, k) -> Column:
    k = _c(k)
    return vec(*[p * k for p in xyz(v)])


def dot(a, b) -> Column:
    (ax, ay, az), (bx, by, bz) = xyz(a), xyz(b)
    return ax * bx + ay * by + az * bz


def norm(v) -> Column:
    return F.sqrt(dot(v, v))


def dist(a, b) -> Column:
    return norm(sub(a, b))


def cross(a, b) -> Column:
    (ax, ay, az), (bx, by, bz) = xyz(a), xyz(b)
    return vec(ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx)


def unit(v) -> Column:
    """Normalised vector; a zero vector is returned as it is."""
    n = norm(v)
    return vec(*[F.when(n > 0, p / n).otherwise(p) for p in xyz(v)])


def drop_axis(v, axis: str) -> Column:
    """The two remaining coordinates, named ``a`` and ``b``, in x, y, z order."""
    if axis not in AXES:
        raise ValueError(f"unknown axis {axis!r}")
    v = _c(v)
    keep = [k for k in AXES if k != axis]
    return F.struct(v[keep[0]].alias("a"), v[keep[1]].alias("b"))


# ------------------------------------------------------------------ 3x3

def mat(*cells) -> Column:
    cells = [_c(c) for c in cells]
    return _built(F.array(*cells), cells)


def entry(m, i: int, j: int, n: int = 3) -> Column:
    if _cells(m):
        return _cells(m)[n * i + j]
    return _c(m)[n * i + j]


def row(m, i: int) -> Column:
    return vec(entry(m, i, 0), entry(m, i, 1), entry(m, i, 2))


def down_direction(rotation) -> Column:
    """World direction below the camera: row 1 of the world-to-camera rotation."""
    return row(rotation, 1)


def transpose(m) -> Column:
    return mat(*[entry(m, j, i) for i in range(3) for j in range(3)])


def matmul(a, b, n: int = 3) -> Column:
    cells = []
    for i in range(n):
        for j in range(n):
            cell = entry(a, i, 0, n) * entry(b, 0, j, n)
            for k in range(1, n):
                cell = cell + entry(a, i, k, n) * entry(b, k, j, n)
            cells.append(cell)
    return mat(*cells)


def matmul_loop(a, b, n: int = 4) -> Column:
    """``matmul`` of columns as a loop over the cells. Written out, the cells of a 4x4 product make a method too long for
    the JVM to compile, which costs more than the loop."""
    a, b = _c(a), _c(b)

    def cell(at: Column) -> Column:
        j = at % n
        out = a[at - j] * b[j]
        for k in range(1, n):
            out = out + a[at - j + k] * b[j + k * n]
        return out

    return F.transform(F.array(*[F.lit(i) for i in range(n * n)]), cell)


def matvec(m, v) -> Column:
    x, y, z = xyz(v)
    return vec(*[entry(m, i, 0) * x + entry(m, i, 1) * y + entry(m, i, 2) * z for i in range(3)])


def det3(m, n: int = 3) -> Column:
    e = lambda i, j: entry(m, i, j, n)
    return (e(0, 0) * (e(1, 1) * e(2, 2) - e(1, 2) * e(2, 1))
            - e(0, 1) * (e(1, 0) * e(2, 2) - e(1, 2) * e(2, 0))
            + e(0, 2) * (e(1, 0) * e(2, 1) - e(1, 1) * e(2, 0)))


def identity3() -> Column:
    return mat(1, 0, 0, 0, 1, 0, 0, 0, 1)


def rotation_y(rad) -> Column:
    rad = _c(rad)
    return mat(F.cos(rad), 0, F.sin(rad), 0, 1, 0, -F.sin(rad), 0, F.cos(rad))


def embed_rotation(r2, axis: str) -> Column:
    """3x3 rotation about ``axis`` that acts as the 2x2 matrix ``r2`` on the other two axes."""
    a, b, c, d = [_c(r2)[i] for i in range(4)]
    if axis == "x":
        return mat(1, 0, 0, 0, a, b, 0, c, d)
    if axis == "y":
        return mat(a, 0, b, 0, 1, 0, c, 0, d)
    if axis == "z":
        return mat(a, b, 0, c, d, 0, 0, 0, 1)
    raise ValueError(f"unknown axis {axis!r}")


# ------------------------------------------------------------------ 4x4 similarity

def similarity(v, c, r, t) -> Column:
    """``c * R v + t``."""
    return add(times(matvec(r, v), c), t)


def to_mat4(c, r, t) -> Column:
    c = _c(c)
    tx, ty, tz = xyz(t)
    e = lambda i, j: c * entry(r, i, j)
    return mat(e(0, 0), e(0, 1), e(0, 2), tx, e(1, 0), e(1, 1), e(1, 2), ty,
               e(2, 0), e(2, 1), e(2, 2), tz, 0, 0, 0, 1)


def mat4_scale(m) -> Column:
    return F.cbrt(det3(m, 4))


def mat4_rotation(m) -> Column:
    s = mat4_scale(m)
    return mat(*[entry(m, i, j, 4) / s for i in range(3) for j in range(3)])


def mat4_offset(m) -> Column:
    return vec(entry(m, 0, 3, 4), entry(m, 1, 3, 4), entry(m, 2, 3, 4))


def mat4_apply(m, v) -> Column:
    x, y, z = xyz(v)
    return vec(*[entry(m, i, 0, 4) * x + entry(m, i, 1, 4) * y + entry(m, i, 2, 4) * z
                 + entry(m, i, 3, 4) for i in range(3)])


def mat4_inverse(m) -> Column:
    """Inverse of a similarity: ``[sR | t]`` becomes ``[R'/s | -R't/s]``."""
    s2 = mat4_scale(m) * mat4_scale(m)
    inv = lambda i, j: entry(m, j, i, 4) / s2
    t = xyz(mat4_offset(m))
    off = [-(inv(i, 0) * t[0] + inv(i, 1) * t[1] + inv(i, 2) * t[2]) for i in range(3)]
    return mat(inv(0, 0), inv(0, 1), inv(0, 2), off[0], inv(1, 0), inv(1, 1), inv(1, 2), off[1],
               inv(2, 0), inv(2, 1), inv(2, 2), off[2], 0, 0, 0, 1)



# ------------------------------------------------------------------ axis / angle, quaternions

def rodrigues(axis, rad) -> Column:
    """Rotation matrix of an axis scaled rotation; the axis need not be normalised, its length
    multiplies the angle."""
    length = norm(axis)
    x, y, z = xyz(unit(axis))
    c, s = F.cos(_c(rad) * length), F.sin(_c(rad) * length)
    k = 1 - c
    return mat(c + x * x * k, x * y * k - z * s, x * z * k + y * s,
               y * x * k + z * s, c + y * y * k, y * z * k - x * s,
               z * x * k - y * s, z * y * k + x * s, c + z * z * k)


def compose(scale, angle_deg, axis, offset) -> Column:
    """4x4 matrix: rotate, then scale, then translate."""
    return to_mat4(scale, rodrigues(axis, F.radians(_c(angle_deg))), offset)


def _quat(parts) -> Column:
    parts = list(parts)
    return _built(F.struct(*[p.alias(q) for p, q in zip(parts, QUAT)]), parts)


def _quat_parts(q) -> list[Column]:
    return list(_cells(q)) if _cells(q) else [_c(q)[p] for p in QUAT]


def quaternion(m) -> Column:
    """Quaternion ``struct<qx, qy, qz, qw>`` of a rotation matrix, up to sign."""
    e = lambda i, j: entry(m, i, j)
    trace = e(0, 0) + e(1, 1) + e(2, 2)

    def branch(big, parts):
        s = F.sqrt(F.greatest(big, F.lit(0.0))) * 2.0
        return [p / s if p is not None else s / 4.0 for p in parts]

    by_w = branch(1 + trace, [e(2, 1) - e(1, 2), e(0, 2) - e(2, 0), e(1, 0) - e(0, 1), None])
    by_x = branch(1 + e(0, 0) - e(1, 1) - e(2, 2),
                  [None, e(0, 1) + e(1, 0), e(0, 2) + e(2, 0), e(2, 1) - e(1, 2)])
    by_y = branch(1 + e(1, 1) - e(0, 0) - e(2, 2),
                  [e(0, 1) + e(1, 0), None, e(1, 2) + e(2, 1), e(0, 2) - e(2, 0)])
    by_z = branch(1 + e(2, 2) - e(0, 0) - e(1, 1),
                  [e(0, 2) + e(2, 0), e(1, 2) + e(2, 1), None, e(1, 0) - e(0, 1)])
    return _quat([F.when(trace > 0, w)
                  .when((e(0, 0) >= e(1, 1)) & (e(0, 0) >= e(2, 2)), x)
                  .when(e(1, 1) >= e(2, 2), y).otherwise(z)
                  for w, x, y, z in zip(by_w, by_x, by_y, by_z)])


def quaternion_angle(q) -> Column:
    """Rotation angle in [0, pi] of a quaternion of either sign."""
    x, y, z, w = _quat_parts(q)
    return 2.0 * F.atan2(F.sqrt(x * x + y * y + z * z), F.abs(w))


def quaternion_axis(q) -> Column:
    """Rotation axis; NULL for the identity."""
    x, y, z, w = _quat_parts(q)
    n = F.sqrt(x * x + y * y + z * z) * F.when(w < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(F.abs(n) > 1e-12, vec(x / n, y / n, z / n))


def quaternion_matrix(q) -> Column:
    x, y, z, w = _quat_parts(q)
    return mat(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
               2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
               2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y))


def with_rotation_vector(df: DataFrame, rotation: str, out: str) -> DataFrame:
    """Add axis times angle (radians) of a rotation; zero vector for the identity."""
    staged = df.withColumn("_q", quaternion(rotation)).withColumns({
        "_ax": quaternion_axis("_q"), "_an": quaternion_angle("_q")})
    value = vec(*[F.coalesce(F.col("_ax")[a] * F.col("_an"), F.lit(0.0)) for a in AXES])
    return staged.withColumn(out, value).drop("_q", "_ax", "_an")


def with_decomposition(df: DataFrame, matrix: str, out: str) -> DataFrame:
    """Add ``struct<scale, axis, angle_deg, offset>`` of a 4x4 similarity; identity has no axis."""
    staged = df.withColumn("_sc", mat4_scale(matrix)).withColumn("_rot", mat(*[
        entry(matrix, i, j, 4) / F.col("_sc") for i in range(3) for j in range(3)])) \
        .withColumn("_q", quaternion("_rot"))
    value = F.struct(F.col("_sc").alias("scale"), quaternion_axis("_q").alias("axis"),
                     F.degrees(quaternion_angle("_q")).alias("angle_deg"),
                     mat4_offset(matrix).alias("offset"))
    return staged.withColumn(out, value).drop("_sc", "_rot", "_q")


def slerp(q0, q1, f) -> Column:
    """Shortest-arc interpolation between two unit quaternions."""
    p0, p1, f = _quat_parts(q0), _quat_parts(q1), _c(f)
    d = p0[0] * p1[0] + p0[1] * p1[1] + p0[2] * p1[2] + p0[3] * p1[3]
    sign = F.when(d < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    ang = F.acos(F.least(F.abs(d), F.lit(1.0)))
    s = F.sin(ang)
    near = s < 1e-9
    w0 = F.when(near, 1.0 - f).otherwise(F.try_divide(F.sin((1.0 - f) * ang), s))
    w1 = F.when(near, f).otherwise(F.try_divide(F.sin(f * ang), s)) * sign
    return _quat([a * w0 + b * w1 for a, b in zip(p0, p1)])


# ------------------------------------------------------------------ relations between poses

def relative_transform(main_center, main_rotation, main_center_2, sub_center, sub_rotation,
                       sub_center_2) -> Column:
    """4x4 taking the sub scene to the main scene from two poses seen in both: scale from the
    ratio of distances, rotation ``Rm' Rs``, offset from the first pose."""
    scale = F.try_divide(dist(main_center, main_center_2), dist(sub_center, sub_center_2))
    rot = matmul(transpose(main_rotation), sub_rotation)
    offset = sub(main_center, times(matvec(rot, sub_center), scale))
    return to_mat4(scale, rot, offset)


def rebase_transform(main, local, own) -> tuple[Column, Column]:
    """Two steps of ``T_main * T_local * T_own^-1``: first factor pair, then the inverse, to be
    multiplied in a following ``withColumn``."""
    return matmul(main, local, 4), mat4_inverse(own)



def flat_to_rows(m, n: int = 3) -> Column:
    return F.array(*[F.array(*[entry(m, i, j, n) for j in range(n)]) for i in range(n)])


def point_to_array(v) -> Column:
    return F.when(_c(v).isNotNull(), F.array(*xyz(v)))
