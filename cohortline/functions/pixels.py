"""Image steps as expressions on ``STRUCT<height, width, pixels>`` (row-major pixels).

Each step is row-wise, needs no shuffle and no Python worker. Element lookups through
higher-order functions suit small images; ``operators.images`` has the array form of the same
steps for large ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .hashing import coin

NO_PIXELS = "array<int>"


def make_image(height: Column, width: Column, pixels: Column) -> Column:
    return F.struct(
        height.cast("int").alias("height"),
        width.cast("int").alias("width"),
        pixels.cast("array<double>").alias("pixels"),
    )


def _on(img: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the image, computed once; null for a null image."""
    return let(img, lambda im: F.when(im.isNotNull(), body(im)))


def _indices(count: Column) -> Column:
    """0 .. count-1; an empty array for 0."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast(NO_PIXELS))


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b).cast("int")


def _row(im: Column, row: Column, first: Column | None = None, count: Column | None = None) -> Column:
    """``count`` pixels of a row from column ``first``, as one slice; the whole row by default."""
    start = row * im.width + 1 if first is None else row * im.width + first + 1
    return F.slice(im.pixels, start, im.width if count is None else count)


def _window(im: Column, height: Column, width: Column, top: Column, left: Column) -> Column:
    """A height x width window of the image whose first pixel is (top, left); 0 outside.

    Works by whole rows: zeros, a slice of the source row, zeros.
    """

    def fill(f: Column) -> Column:
        def line(r: Column) -> Column:
            source = r + f.top
            inside = (source >= 0) & (source < im.height) & (f["count"] > 0)
            zeros_before, zeros_after = (F.array_repeat(F.lit(0.0), f[n]) for n in ("before", "after"))
            part = F.concat(zeros_before, _row(im, source, f["first"], f["count"]), zeros_after)
            return F.when(inside, part).otherwise(F.array_repeat(F.lit(0.0), f.width))

        return make_image(f.height, f.width, F.flatten(F.transform(_indices(f.height), line)))

    first = F.greatest(left, F.lit(0))
    before = F.least(F.greatest(-left, F.lit(0)), width)
    count = F.greatest(F.least(im.width, left + width) - first, F.lit(0))
    frame = F.struct(
        height.cast("int").alias("height"),
        width.cast("int").alias("width"),
        top.cast("int").alias("top"),
        first.cast("int").alias("first"),
        count.cast("int").alias("count"),
        before.cast("int").alias("before"),
        (width - before - count).cast("int").alias("after"),
    )
    return let(frame, fill)


def _map_pixels(im: Column, change: Callable[[Column], Column]) -> Column:
    return make_image(im.height, im.width, F.transform(im.pixels, change))


def ensure_2d(dims: Column, pixels: Column) -> Column:
    """Drop dimensions of size 1; null if more than two real dimensions are left.

    One real dimension becomes a row of pixels, none a single pixel.
    """
    real = F.filter(dims, lambda d: d > 1)
    height = F.when(F.size(real) == 2, F.get(real, F.lit(0))).otherwise(F.lit(1))
    width = F.when(F.size(real) == 2, F.get(real, F.lit(1))).when(F.size(real) == 1, F.get(real, F.lit(0)))
    return F.when(F.size(real) <= 2, make_image(height, F.coalesce(width, F.lit(1)), pixels))


def between_zero_and_max(value: Column, top: Column) -> Column:
    """Foreground test: above zero and below the image maximum."""
    return (value > 0) & (value < top)


def foreground_box(img: Column, select: Callable[[Column, Column], Column] = between_zero_and_max) -> Column:
    """Smallest box ``STRUCT<top, left, bottom, right>`` (ends excluded) around selected pixels.

    All four are 0 if no pixel is selected.
    """

    def hits(im: Column) -> Column:
        """Rows with a selected pixel: row number, first and last selected column."""

        def ends(row: Column, flags: Column) -> Column:
            return F.struct(
                row.alias("row"),
                F.array_position(flags, F.lit(True)).cast("int").alias("first"),
                F.array_position(F.reverse(flags), F.lit(True)).cast("int").alias("from_end"),
            )

        def rows(most: Column) -> Column:
            return F.transform(
                _indices(im.height),
                lambda r: let(F.transform(_row(im, r), lambda v: select(v, most)), lambda flags: ends(r, flags)),
            )

        return F.filter(let(F.array_max(im.pixels), rows), lambda e: e["first"] > 0)

    def box(width: Column, found: Column) -> Column:
        def least(field: str) -> Column:
            return F.array_min(F.transform(found, lambda e: e[field]))

        zero = F.lit(0)
        return F.struct(
            F.coalesce(least("row"), zero).alias("top"),
            F.coalesce(least("first") - 1, zero).alias("left"),
            F.coalesce(F.array_max(F.transform(found, lambda e: e["row"])) + 1, zero).alias("bottom"),
            F.coalesce(width - least("from_end") + 1, zero).alias("right"),
        )

    return _on(img, lambda im: let(hits(im), lambda found: box(im.width, found)))


def crop(img: Column, box: Column) -> Column:
    """Cut the box out of the image; an empty box gives a 0 x 0 image."""
    return _on(
        F.when(img.isNotNull(), F.struct(img.alias("im"), box.alias("box"))),
        lambda s: _window(s.im, s.box.bottom - s.box.top, s.box.right - s.box.left, s.box.top, s.box.left),
    )


def crop_foreground(
    img: Column, select: Callable[[Column, Column], Column] = between_zero_and_max
) -> Column:
    """Crop to the box around the selected pixels; 0 x 0 if there is none."""
    return _on(img, lambda im: crop(im, foreground_box(im, select)))


def resized_side(side: Column, longest: Column, size: int) -> Column:
    """Side after scaling the longest side to ``size``; halves go to the even number."""
    return F.greatest(F.rint(side * (F.lit(float(size)) / longest)).cast("int"), F.lit(1))


def resize_longest(img: Column, size: int = 256) -> Column:
    """Scale by area averages so that the longest side becomes ``size``; aspect kept.

    Target row i averages source rows floor(iH/h) up to but not including ceil((i+1)H/h);
    columns alike. An empty image stays empty.
    """

    def scaled(s: Column) -> Column:
        def span(i: Column, source: Column, target: Column) -> Column:
            first = _div(i * source, target)
            return F.struct(
                first.alias("first"), (F.ceil((i + 1) * source / target).cast("int") - first).alias("count")
            )

        def average(k: Column) -> Column:
            def mean(c: Column) -> Column:
                cells = F.flatten(
                    F.transform(
                        F.sequence(c["rows"]["first"], c["rows"]["first"] + c["rows"]["count"] - 1),
                        lambda r: F.slice(
                            s.im.pixels, r * s.im.width + c["cols"]["first"] + 1, c["cols"]["count"]
                        ),
                    )
                )
                total = F.aggregate(cells, F.lit(0.0), lambda acc, x: acc + x)
                return total / (c["rows"]["count"] * c["cols"]["count"])

            cell = F.struct(
                span(_div(k, s.width), s.im.height, s.height).alias("rows"),
                span(k % s.width, s.im.width, s.width).alias("cols"),
            )
            return let(cell, mean)

        return make_image(s.height, s.width, F.transform(_indices(s.height * s.width), average))

    def resize(im: Column) -> Column:
        longest = F.greatest(im.height, im.width)
        sides = F.struct(
            im.alias("im"),
            resized_side(im.height, longest, size).alias("height"),
            resized_side(im.width, longest, size).alias("width"),
        )
        return F.when(im.height * im.width > 0, let(sides, scaled)).otherwise(im)

    return _on(img, resize)


def pad_or_crop(img: Column, height: int = 256, width: int = 256) -> Column:
    """Centre pad with 0 or centre crop to the exact size, each side by itself."""

    def start(side: Column, target: int) -> Column:
        return F.when(side < target, -_div(F.lit(target) - side, 2)).otherwise(_div(side, 2) - target // 2)

    return _on(
        img,
        lambda im: _window(im, F.lit(height), F.lit(width), start(im.height, height), start(im.width, width)),
    )


def divisible_pad(img: Column, k: int = 32) -> Column:
    """Centre pad each side to the next multiple of ``k``."""

    def pad(im: Column) -> Column:
        height, width = (F.ceil(im.height / k) * k).cast("int"), (F.ceil(im.width / k) * k).cast("int")
        return _window(im, height, width, -_div(height - im.height, 2), -_div(width - im.width, 2))

    return _on(img, pad)


def scale_intensity(img: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Min-max scale to [lo, hi]; a constant image becomes value * lo."""

    def scale(s: Column) -> Column:
        return _map_pixels(
            s.im,
            lambda v: F.when(s.most == s.least, v * F.lit(float(lo))).otherwise(
                (v - s.least) / (s.most - s.least) * F.lit(float(hi - lo)) + F.lit(float(lo))
            ),
        )

    return _on(
        img,
        lambda im: let(
            F.struct(
                im.alias("im"), F.array_min(im.pixels).alias("least"), F.array_max(im.pixels).alias("most")
            ),
            scale,
        ),
    )


def to_uint8(img: Column) -> Column:
    """Drop fractions and hold the values in 0..255."""
    return _on(
        img,
        lambda im: _map_pixels(
            im, lambda v: F.floor(F.least(F.greatest(v, F.lit(0.0)), F.lit(255.0))).cast("double")
        ),
    )


def to_float(img: Column) -> Column:
    """Pixels as 32-bit floats, the storage type."""
    return _on(
        img,
        lambda im: F.struct(
            im.height.alias("height"), im.width.alias("width"), im.pixels.cast("array<float>").alias("pixels")
        ),
    )


def flip(img: Column, axis: int = 0) -> Column:
    """Turn the image upside down (axis 0) or left to right (axis 1)."""

    def turned(im: Column) -> Column:
        def line(r: Column) -> Column:
            return _row(im, im.height - 1 - r) if axis == 0 else F.reverse(_row(im, r))

        return make_image(im.height, im.width, F.flatten(F.transform(_indices(im.height), line)))

    return _on(img, turned)


def random_flip(
    img: Column, image_id: Column, p: float = 0.5, axis: int = 0, seed: object = 42, epoch: int = 0
) -> Column:
    """Flip along ``axis`` with probability ``p``; the draw depends on (seed, epoch, id) only."""
    return F.when(coin(p, f"{seed}:{epoch}", image_id), flip(img, axis)).otherwise(img)
