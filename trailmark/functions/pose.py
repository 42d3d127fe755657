"""4x4 matrices as arrays of 16 doubles in row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matmul(a: Column, b: Column) -> Column:
    return F.array(*[sum((a[4 * i + t] * b[4 * t + j] for t in range(1, 4)), a[4 * i] * b[j]) for i in range(4) for j in range(4)])


def rigid_inverse(m: Column) -> Column:
    """Of a rotation and translation: transpose, and minus the transposed rotation of the translation."""
    rows = []
    for i in range(3):
        rows += [m[i], m[4 + i], m[8 + i], -(m[i] * m[3] + m[4 + i] * m[7] + m[8 + i] * m[11])]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def determinant3(m: Column) -> Column:
    return m[0] * (m[5] * m[10] - m[6] * m[9]) - m[1] * (m[4] * m[10] - m[6] * m[8]) + m[2] * (m[4] * m[9] - m[5] * m[8])


def ground_pose(x: Column, z: Column, fx: Column, fz: Column, floor_y: float, lift: float = 0.0) -> Column:
    """Pose of a robot at (x, z) that looks along the unit vector (fx, fz), lifted above the floor."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(fx, -fz, zero, x, zero, zero, F.lit(-1.0), F.lit(floor_y - lift), fz, fx, zero, z, zero, zero, zero, one)


def orthonormal_error(m: Column) -> Column:
    """Largest entry of |R'R - I|."""
    terms = [F.abs(sum((m[4 * k + i] * m[4 * k + j] for k in range(1, 3)), m[i] * m[j]) - F.lit(1.0 if i == j else 0.0)) for i in range(3) for j in range(i, 3)]
    return F.greatest(*terms)


def change_of_world(m: Column) -> Column:
    """[x, y, z] -> [x, -z, y] applied to a pose from the left."""
    return F.array(*[m[k] for k in range(4)], *[-m[8 + k] for k in range(4)], *[m[4 + k] for k in range(4)], *[m[12 + k] for k in range(4)])


def project(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    """Pinhole pixel of a camera point; null where it isn't in front."""
    front = z > 0
    return F.when(front, F.lit(fx) * x / z + F.lit(cx)), F.when(front, F.lit(fy) * y / z + F.lit(cy))


def unproject(u: Column, v: Column, depth: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column, Column]:
    return (u - F.lit(cx)) / F.lit(fx) * depth, (v - F.lit(cy)) / F.lit(fy) * depth, depth


def rotation_from_degrees(roll: Column, pitch: Column, yaw: Column) -> Column:
    """Rz * Ry * Rx as nine doubles in row order."""
    cr, sr, cp, sp, cy, sy = (f(F.radians(a)) for a in (roll, pitch, yaw) for f in (F.cos, F.sin))
    return F.array(cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr)


#: Axes of an optical frame (right, down, forward) in a link frame (forward, left, up).
OPTICAL_IN_LINK = ((0.0, 0.0, 1.0), (-1.0, 0.0, 0.0), (0.0, -1.0, 0.0))


def camera_mount(x: float, y: float, z: float) -> Column:
    """Pose of an optical frame at an offset in the base frame, turned as the base."""
    rows = [v for row, t in zip(OPTICAL_IN_LINK, (x, y, z), strict=True) for v in (*row, t)]
    return F.array(*[F.lit(v) for v in (*rows, 0.0, 0.0, 0.0, 1.0)])


def intrinsics(fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(fx, zero, cx, zero, fy, cy, zero, zero, one)


def dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def unit(a: list[Column]) -> list[Column]:
    n = F.nullif(F.sqrt(dot(a, a)), F.lit(0.0))
    return [x / n for x in a]


def look_at(eye: list[Column], target: list[Column], up: list[float]) -> Column:
    """World-to-camera matrix (right, down, forward rows); another up is taken where the view is along the given one."""
    forward = unit([t - e for t, e in zip(target, eye, strict=True)])
    first = cross(forward, [F.lit(x) for x in up])
    steep = F.abs(forward[1]) >= 0.9
    other = cross(forward, [F.when(steep, 1.0).otherwise(0.0), F.when(steep, 0.0).otherwise(1.0), F.lit(0.0)])
    along = F.sqrt(dot(first, first)) < 1e-6
    right = unit([F.when(along, o).otherwise(f) for f, o in zip(first, other, strict=True)])
    rows = [right, unit(cross(forward, right)), forward]
    return F.array(*[x for row in rows for x in (*row, -dot(row, eye))], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def to_local(dx: Column, dz: Column, fx: Column, fz: Column) -> tuple[Column, Column]:
    """A world displacement as forward and left of a heading."""
    return fx * dx + fz * dz, fx * dz - fz * dx


def close(a: Column, b: Column, atol: float, rtol: float = 1e-5) -> Column:
    """Whether all entries of a are within atol + rtol * |b| of b's; false where lengths differ."""
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.coalesce(F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y), F.lit(False))), lambda ok: ok)
