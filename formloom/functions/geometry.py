"""Page geometry: percentages, pixels, boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An A4 page at 300 dpi, for documents that don't give their size.
PAGE_WIDTH, PAGE_HEIGHT = 2480, 3508


def pixels(percent: float, size: Column) -> Column:
    """A percentage of a length in whole pixels, cut off."""
    return (F.lit(percent / 100.0) * size).cast("int")


def percent(pixel: Column, size: Column) -> Column:
    return F.when(size > 0, pixel / size * 100.0).otherwise(F.lit(0.0))


def page_width(width: Column) -> Column:
    return F.coalesce(width, F.lit(PAGE_WIDTH))


def page_height(height: Column) -> Column:
    return F.coalesce(height, F.lit(PAGE_HEIGHT))


def normalise_y(y: Column, height: Column) -> Column:
    """0 to 1; a height that is not positive is an error."""
    return F.when(height > 0, y / height).otherwise(F.raise_error(F.lit("height must be positive")).cast("double"))


def denormalise(start: Column, end: Column, height: Column) -> Column:
    """(start, end) in pixels, rounded half to even, within the page, end not above start."""
    spot = lambda n: F.least(F.greatest(F.rint(height * n), F.lit(0.0)), height.cast("double")).cast("int")
    return F.struct(spot(start).alias("start"), F.greatest(spot(start), spot(end)).alias("end"))


def rescale_polygon(points: Column, inverse_scale: Column, dx: Column, dy: Column) -> Column:
    """The first four points of a local polygon on the page: (polygon, center), all whole pixels."""
    four = F.slice(points, 1, 4)
    local = F.transform(four, lambda p: F.transform(p, lambda v: (v * inverse_scale).cast("int")))
    moved = F.transform(local, lambda p: F.array(p[0] + dx, p[1] + dy))
    mean = lambda k: (F.aggregate(moved, F.lit(0).cast("int"), lambda a, p: a + p[k]) / F.size(moved)).cast("int")
    return F.struct(moved.alias("polygon"), F.array(mean(0), mean(1)).alias("center"), local.alias("local"))


def cell_box(x0: Column, y0: Column, x1: Column, y1: Column, dy: Column) -> Column:
    """A cell as four points, clockwise from the top left, and its center, moved down by dy."""
    point = lambda x, y: F.array(x, y + dy)
    middle = F.array(F.floor((x0 + x1) / 2).cast("int"), F.floor((y0 + y1) / 2).cast("int") + dy)
    return F.struct(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)).alias("polygon"), middle.alias("center"))


def round3(value: Column) -> Column:
    """Three decimals of the exact binary value, ties to even; Spark's round works on the decimal form.

    The value is split into a part of 24 bits and the rest, so that both times 1000 are exact; their sum and
    its error tell on which side of a half the exact product lies. For values below a billion.
    """
    high = value.cast("float").cast("double")
    a, b = high * 1000.0, (value - high) * 1000.0
    total = a + b
    part = total - a
    error = (a - (total - part)) + (b - part)
    down = F.floor(total).cast("double")
    half = (total - down) == 0.5
    return F.when(half & (error > 0), down + 1).when(half & (error < 0), down).otherwise(F.rint(total)) / 1000.0


def fit_within(width: Column, height: Column, most_width: int, most_height: int) -> Column:
    """The scale, 1 at most, at which a size fits."""
    return F.least(F.lit(1.0), F.lit(most_width) / width, F.lit(most_height) / height)


def too_large(width: Column, height: Column, most_width: int = 3000, most_height: int = 2000) -> Column:
    return (width > most_width) | (height > most_height)


def longest_side(width: Column, height: Column, most: int = 3000) -> Column:
    """The size at which the longest side fits, whole pixels cut off."""
    scale = F.least(F.lit(1.0), F.lit(most) / F.greatest(width, height))
    return F.struct((width * scale).cast("int").alias("width"), (height * scale).cast("int").alias("height"))


def adaptive_size(width: Column, height: Column, least_mp: float = 4.0, target_mp: float = 5.0, most_width: int = 3000, most_height: int = 2000) -> Column:
    """Pages below the least megapixels grow to the target, within the largest width and height; whole pixels cut off."""
    area = width.cast("double") * height
    scale = F.least(F.sqrt(F.lit(target_mp * 1e6) / area), F.lit(most_width) / width, F.lit(most_height) / height)
    grows = area / 1e6 < least_mp
    return F.struct(
        F.when(grows, (width * scale).cast("int")).otherwise(width).alias("width"), F.when(grows, (height * scale).cast("int")).otherwise(height).alias("height")
    )


def turn_of(angles: Column) -> Column:
    """The median of the angles of a page's lines where that is 2 to 45 degrees either way, else 0."""
    ordered, n = F.sort_array(angles), F.size(angles)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    middle = (low + high) / 2.0
    return F.when((n > 0) & F.abs(middle).between(2.0, 45.0), middle).otherwise(0.0)


def corners_ok(quad: Column, least: float = 50.0) -> Column:
    """True for four points in turn whose sides are long enough and whose turns all go the same way."""
    at = lambda i: quad[i % 4]
    side = lambda i: F.sqrt(F.pow(at(i + 1)[0] - at(i)[0], F.lit(2)) + F.pow(at(i + 1)[1] - at(i)[1], F.lit(2)))
    turn = lambda i: (at(i + 1)[0] - at(i)[0]) * (at(i + 2)[1] - at(i + 1)[1]) - (at(i + 1)[1] - at(i)[1]) * (at(i + 2)[0] - at(i + 1)[0])
    turns = [turn(i) for i in range(4)]
    return (F.size(quad) == 4) & (F.least(*(side(i) for i in range(4))) >= least) & ((F.least(*turns) > 0) | (F.greatest(*turns) < 0))
