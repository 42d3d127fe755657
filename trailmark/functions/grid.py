"""Grid and frame arithmetic on coordinate columns. World axes: X right, Y down, Z forward."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(raw: Column, scale: float, offset: float = 0.0) -> Column:
    """Fixed-point record value to metres."""
    return raw * F.lit(scale) + F.lit(offset)


def z_up_to_y_down(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """[x, y, z] with Z up to world [x, -z, y]."""
    return x, -z, y


def cell(value: Column, origin: float, resolution: float) -> Column:
    """Index of the cell that holds a coordinate; rounds down for negative ones too."""
    return F.floor((value - F.lit(origin)) / F.lit(resolution)).cast("bigint")


def cell_centre(index: Column, origin: float, resolution: float) -> Column:
    return F.lit(origin) + (index + F.lit(0.5)) * F.lit(resolution)


def height(y: Column, floor_y: Column | float) -> Column:
    """Height above the floor; Y points down."""
    return (floor_y if isinstance(floor_y, Column) else F.lit(floor_y)) - y


def finite(x: Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite (Spark's NaN compares greater than all)."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def in_rectangle(x: Column, z: Column, x0: float, x1: float, z0: float, z1: float) -> Column:
    return x.between(x0, x1) & z.between(z0, z1)


def region_bounds(cx: Column, cz: Column, width: float, depth: float, pad: float) -> tuple[Column, Column, Column, Column]:
    """x0, x1, z0, z1 of a rectangle around a centre, with padding."""
    return cx - F.lit(width / 2 + pad), cx + F.lit(width / 2 + pad), cz - F.lit(depth / 2 + pad), cz + F.lit(depth / 2 + pad)


def to_screen(x: Column, z: Column, zoom: float, pan_x: float, pan_z: float) -> tuple[Column, Column]:
    return (x - F.lit(pan_x)) * F.lit(zoom), (z - F.lit(pan_z)) * F.lit(zoom)


def from_screen(u: Column, v: Column, zoom: float, pan_x: float, pan_z: float) -> tuple[Column, Column]:
    return u / F.lit(zoom) + F.lit(pan_x), v / F.lit(zoom) + F.lit(pan_z)


def in_grid(i: Column, j: Column, width: int, height: int) -> Column:
    """Half-open index test."""
    return (i >= 0) & (i < width) & (j >= 0) & (j < height)
