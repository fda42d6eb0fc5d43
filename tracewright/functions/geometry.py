"""Camera geometry as column expressions. Matrices are row-major arrays: K has 9 numbers, w2c has 16; points are tuples of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, ...]


def matrix(values: list[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def at(m: Column, k: int) -> Column:
    return F.get(m, F.lit(k))


def apply_extrinsics(m: Column, p: Point) -> Point:
    """A 4x4 matrix on a homogeneous point, divided by its last coordinate."""
    rows = [at(m, 4 * r) * p[0] + at(m, 4 * r + 1) * p[1] + at(m, 4 * r + 2) * p[2] + at(m, 4 * r + 3) for r in range(4)]
    return tuple(x / rows[3] for x in rows[:3])


def project(k: Column, p: Point, eps: float = 1e-8) -> Point:
    """Camera point to (u, v, z)."""
    x = at(k, 0) * p[0] + at(k, 1) * p[1] + at(k, 2) * p[2]
    y = at(k, 3) * p[0] + at(k, 4) * p[1] + at(k, 5) * p[2]
    z = at(k, 6) * p[0] + at(k, 7) * p[1] + at(k, 8) * p[2]
    return x / (z + eps), y / (z + eps), p[2]


def project_world(k: Column, w2c: Column, p: Point) -> Point:
    return project(k, apply_extrinsics(w2c, p))


def unproject(k: Column, u: Column, v: Column, z: Column) -> Point:
    """Pixel and depth to camera point, for K without skew."""
    return (u - at(k, 2)) * z / at(k, 0), (v - at(k, 5)) * z / at(k, 4), z


def inverse_se3(m: Column) -> Column:
    """Of a rotation and translation."""
    r = [[at(m, 4 * i + j) for j in range(3)] for i in range(3)]
    t = [at(m, 4 * i + 3) for i in range(3)]
    out: list[Column] = []
    for i in range(3):
        out += [r[0][i], r[1][i], r[2][i], -(r[0][i] * t[0] + r[1][i] * t[1] + r[2][i] * t[2])]
    return F.array(*out, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def inverse_k(k: Column) -> Column:
    """Of intrinsics with skew."""
    fx, s, cx, fy, cy = (at(k, i) for i in (0, 1, 2, 4, 5))
    one, zero = F.lit(1.0), F.lit(0.0)
    return F.array(one / fx, -s / (fx * fy), (s * cy - cx * fy) / (fx * fy), zero, one / fy, -cy / fy, zero, zero, one)


def matmul(a: Column, b: Column, n: int) -> Column:
    return F.array(*(sum((at(a, n * i + k) * at(b, n * k + j) for k in range(1, n)), at(a, n * i) * at(b, j)) for i in range(n) for j in range(n)))


def grid_point(i: Column, n: int, size: Column | float) -> Column:
    """The i-th of n places from 0 to size - 1."""
    return F.lit(0.0) if n == 1 else i * (size - F.lit(1)) / (n - 1)


def log_depth(u: Column, v: Column, z: Column, focal: Column, eps: float = 1e-6) -> Point:
    """G11."""
    return u, v, focal * F.ln(F.greatest(z, F.lit(eps)))


def clamp_pixel(x: Column, size: Column | float, reach: float = 2.0) -> Column:
    """Within so many image sizes on either side."""
    limit = F.lit(reach) * size
    return F.greatest(-limit, F.least(limit, x))


def ray_distance(k: Column, u: Column, v: Column, z: Column) -> Column:
    """Distance along the ray of a depth."""
    x, y, _ = unproject(k, u, v, F.lit(1.0))
    return z * F.sqrt(x * x + y * y + 1)


def depth_of_distance(k: Column, u: Column, v: Column, distance: Column) -> Column:
    """The inverse."""
    x, y, _ = unproject(k, u, v, F.lit(1.0))
    return distance / F.sqrt(x * x + y * y + 1)


def edit_k(k: Column, scale_x: float = 1.0, scale_y: float = 1.0, shift_x: float = 0.0, shift_y: float = 0.0) -> Column:
    """Intrinsics after a resize and then a crop."""
    return F.array(at(k, 0) * scale_x, at(k, 1) * scale_x, at(k, 2) * scale_x - shift_x, at(k, 3), at(k, 4) * scale_y, at(k, 5) * scale_y - shift_y, at(k, 6), at(k, 7), at(k, 8))


def flip_k(k: Column, width: Column | float) -> Column:
    """Intrinsics of the mirrored image."""
    return F.array(at(k, 0), at(k, 1), width - at(k, 2) - 1, *(at(k, i) for i in range(3, 9)))


def crop_point(x: Column, y: Column, left: float, top: float, scale: float = 1.0) -> Point:
    """G15."""
    return (x - left) * scale, (y - top) * scale


def fov(focal: Column, size: Column | float) -> Column:
    """G16."""
    return 2 * F.atan(size / (2 * focal))


def focal_of_fov(angle: Column, size: Column | float) -> Column:
    return size / (2 * F.tan(angle / 2))


def focal_of_35mm(f35: Column, width: Column, height: Column) -> Column:
    """Pixels for a focal length on a 36 x 24 mm frame, by diagonals."""
    return f35 * F.sqrt(width * width + height * height) / F.sqrt(F.lit(36.0 * 36.0 + 24.0 * 24.0))


def quaternion_of_rotvec(x: Column, y: Column, z: Column) -> Point:
    """(w, x, y, z)."""
    angle = F.sqrt(x * x + y * y + z * z)
    s = F.when(angle < 1e-8, 0.5 - angle * angle / 48).otherwise(F.sin(angle / 2) / F.greatest(angle, F.lit(1e-300)))
    return F.cos(angle / 2), x * s, y * s, z * s


def rotvec_of_quaternion(w: Column, x: Column, y: Column, z: Column) -> Point:
    """The shorter way round."""
    sign = F.when(w < 0, -1.0).otherwise(1.0)
    n = F.sqrt(x * x + y * y + z * z)
    s = F.when(n < 1e-12, 2.0).otherwise(2 * F.atan2(n, w * sign) / F.greatest(n, F.lit(1e-300)))
    return x * s * sign, y * s * sign, z * s * sign


def matrix_of_quaternion(w: Column, x: Column, y: Column, z: Column) -> Column:
    """Rotation matrix (9) of a quaternion of any length."""
    n = w * w + x * x + y * y + z * z
    d = lambda e: F.lit(1.0) - 2 * e / n
    o = lambda e: 2 * e / n
    return F.array(d(y * y + z * z), o(x * y - w * z), o(x * z + w * y), o(x * y + w * z), d(x * x + z * z), o(y * z - w * x), o(x * z - w * y), o(y * z + w * x), d(x * x + y * y))


def euler_of_matrix(m: Column) -> Point:
    """Angles about x, y, z (applied in that order) of a rotation matrix (9)."""
    return F.atan2(at(m, 7), at(m, 8)), F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -at(m, 6)))), F.atan2(at(m, 3), at(m, 0))


def rotation_angle(m: Column) -> Column:
    trace = at(m, 0) + at(m, 4) + at(m, 8)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2)))


def angle_between(a: Point, b: Point) -> Column:
    """Of two vectors, by half-angle tangents of their unit vectors."""
    dot = sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    na, nb = (F.sqrt(sum((x * x for x in v[1:]), v[0] * v[0])) for v in (a, b))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / (na * nb))))


def plane_uv(i: Column, j: Column, width: int, height: int) -> Point:
    """Pixel centres on a plane whose diagonal is 2 long."""
    diagonal = (width * width + height * height) ** 0.5
    return (2 * i + 1 - width) / F.lit(diagonal), (2 * j + 1 - height) / F.lit(diagonal)


def triangles(width: int, height: int, spark):
    """Two index triples for each cell of a grid of vertices."""
    cells = spark.range((width - 1) * (height - 1)).select((F.col("id") % (width - 1)).alias("u"), F.floor(F.col("id") / (width - 1)).alias("v"))
    a = F.col("v") * width + F.col("u")
    return cells.select(F.posexplode(F.array(F.array(a, a + width, a + 1), F.array(a + 1, a + width, a + width + 1))).alias("half", "t"), "u", "v").select("u", "v", F.col("half").cast("long").alias("half"), *(F.get("t", F.lit(k)).alias(f"i{k}") for k in range(3)))


def sin_cos(value: Column, bands: int) -> Column:
    """Sines, then cosines, of the value at doubling frequencies."""
    f = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: value * F.pow(F.lit(2.0), k))
    return F.concat(F.transform(f, F.sin), F.transform(f, F.cos))


def relative_pose(first: Column, p: Point) -> Point:
    """A world point in the camera of a clip's first frame."""
    return apply_extrinsics(first, p)


def bilinear(corners: tuple[Column, Column, Column, Column], fu: Column, fv: Column) -> Column:
    """From the values at (0, 0), (1, 0), (0, 1), (1, 1) and the fractions along both axes."""
    a, b, c, d = corners
    return a * (1 - fu) * (1 - fv) + b * fu * (1 - fv) + c * (1 - fu) * fv + d * fu * fv


def resized_height(width: Column, height: Column, to: int = 518, unit: int = 14) -> Column:
    """Height for a new width, rounded (half to even) to whole units."""
    return (F.bround(height * to / width / unit) * unit).cast("long")


def support_point(i: Column, n: int, size: float, width: float) -> Column:
    """The i-th of n places that keep a margin of a 64th of the width; the middle if there is one place."""
    margin = width // 64
    return F.lit(size / 2) if n == 1 else margin + i * (size - 1 - 2 * margin) / (n - 1)


def ndc_focal(focal: Column, height: Column, width: Column) -> Column:
    """In units of half the shorter side."""
    return focal * 2 / F.least(height, width)


def ndc_principal(c: Column, size: Column, height: Column, width: Column) -> Column:
    """G34."""
    return -(c - size / 2) * 2 / F.least(height, width)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def huber(error: Column, delta: float = 1.0) -> Column:
    """A41."""
    e = F.abs(error)
    return F.when(e <= delta, 0.5 * e * e).otherwise(delta * (e - 0.5 * delta))


def cross_entropy(target: Column, logit: Column) -> Column:
    """Of a logit against 0 or 1, in the form that doesn't overflow."""
    return F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))


def quaternion_of_matrix(m: Column) -> Point:
    """(w, x, y, z) with w >= 0 of a rotation matrix (9), by the largest of the four squared parts."""
    a, b, c = at(m, 0), at(m, 4), at(m, 8)
    squares = (1 + a + b + c, 1 + a - b - c, 1 - a + b - c, 1 - a - b + c)
    ways = (
        (squares[0], at(m, 7) - at(m, 5), at(m, 2) - at(m, 6), at(m, 3) - at(m, 1)),
        (at(m, 7) - at(m, 5), squares[1], at(m, 1) + at(m, 3), at(m, 2) + at(m, 6)),
        (at(m, 2) - at(m, 6), at(m, 1) + at(m, 3), squares[2], at(m, 5) + at(m, 7)),
        (at(m, 3) - at(m, 1), at(m, 2) + at(m, 6), at(m, 5) + at(m, 7), squares[3]),
    )
    largest = F.greatest(*squares)
    out = []
    for part in range(4):
        value = F.lit(None).cast("double")
        for square, way in reversed(list(zip(squares, ways, strict=True))):
            sign = F.when(way[0] < 0, -1.0).otherwise(1.0)
            value = F.when(square == largest, sign * way[part] / (2 * F.sqrt(largest))).otherwise(value)
        out.append(value)
    return tuple(out)


def pose_encoding(w2c: Column, k: Column, width: float, height: float) -> Column:
    """Translation, rotation quaternion and fields of view."""
    rotation = F.array(*(at(w2c, 4 * i + j) for i in range(3) for j in range(3)))
    t = [at(w2c, 4 * i + 3) for i in range(3)]
    return F.array(*t, *quaternion_of_matrix(rotation), fov(at(k, 4), height), fov(at(k, 0), width))


def pose_of_encoding(e: Column, width: float, height: float) -> tuple[Column, Column]:
    """(w2c, K) of an encoding, with the principal point in the middle."""
    r = matrix_of_quaternion(*(at(e, i) for i in range(3, 7)))
    w2c = F.array(*(at(r, 3 * i + j) if j < 3 else at(e, i) for i in range(3) for j in range(4)), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    zero = F.lit(0.0)
    return w2c, F.array(focal_of_fov(at(e, 8), width), zero, F.lit(width / 2), zero, focal_of_fov(at(e, 7), height), F.lit(height / 2), zero, zero, F.lit(1.0))


def normalised_colour(value: Column, mean: float = 0.0, std: float = 1.0) -> Column:
    """G36."""
    return (value / 255.0 - mean) / std
