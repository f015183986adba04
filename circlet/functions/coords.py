"""Circular coordinate expressions on 1-based closed positions.

Everything here is a plain column expression, so it stays inside whole-stage
code generation. ``length`` is always a Python int known when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = "struct<start:int,end:int>"


def _c(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def _check(length: int) -> None:
    if length <= 0:
        raise ValueError("length must be positive")


def normalize_pos(pos, length: int, rotation_start=1) -> Column:
    """Position on a rotated reference -> standard position."""
    _check(length)
    return (F.pmod(_c(pos) + _c(rotation_start) - 2, F.lit(length)) + 1).cast("int")


def rotated_pos(pos, length: int, rotation_start=1) -> Column:
    """Standard position -> position on the rotated reference."""
    _check(length)
    return (F.pmod(_c(pos) - _c(rotation_start), F.lit(length)) + 1).cast("int")


def normalize_padded_pos(pos, length: int, padding=0, rotation_start=1) -> Column:
    """As C01 for a reference that carries ``padding`` leading bases."""
    _check(length)
    return (F.pmod(_c(rotation_start) - 1 + _c(pos) - _c(padding) - 1, F.lit(length)) + 1).cast("int")


def directed_gap(left, right, length: int) -> Column:
    """Bases strictly between left and right going forward."""
    left, right = _c(left), _c(right)
    return F.when(right > left, right - left - 1).otherwise(F.lit(length) - left + right - 1).cast("int")


def circular_distance(a, b, length: int) -> Column:
    """Shortest distance between two positions."""
    delta = F.abs(_c(a) - _c(b))
    return F.least(delta, F.lit(length) - delta).cast("int")


def _piece(start, end) -> Column:
    return F.struct(_c(start).cast("int").alias("start"), _c(end).cast("int").alias("end"))


def deleted_pieces(left, right, length: int) -> Column:
    """Closed pieces deleted between two breakpoints (0, 1 or 2)."""
    left, right = _c(left), _c(right)
    wraps = right <= left
    both = F.array(
        _piece(left + 1, F.when(wraps, F.lit(length)).otherwise(right - 1)),
        _piece(F.lit(1), F.when(wraps, right - 1).otherwise(F.lit(0))),
    )
    return F.filter(both, lambda p: p["end"] >= p["start"])


def region_pieces(start, end, length: int) -> Column:
    """Closed region as one or two pieces; positions must lie in 1..length."""
    _check(length)
    start, end = _c(start), _c(end)
    inside = start.between(1, length) & end.between(1, length)
    pieces = F.when(start <= end, F.array(_piece(start, end))).otherwise(
        F.array(_piece(start, F.lit(length)), _piece(F.lit(1), end))
    )
    message = F.lit("circular region coordinates must fall within the reference")
    return F.when(inside, pieces).otherwise(F.raise_error(message).cast(f"array<{PIECE}>"))


def pieces_length(pieces) -> Column:
    """Total length of a set of pieces."""
    return F.aggregate(
        _c(pieces), F.lit(0), lambda acc, p: acc + F.greatest(F.lit(0), p["end"] - p["start"] + 1)
    )


def pieces_overlap(first, second) -> Column:
    """Positions shared by two sets of disjoint closed pieces."""
    second = _c(second)
    return F.aggregate(
        _c(first),
        F.lit(0),
        lambda acc, p: acc
        + F.aggregate(second, F.lit(0), lambda inner, q: inner + _shared(p["start"], p["end"], q["start"], q["end"])),
    )


def _shared(s1, e1, s2, e2) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def deleted_overlap(left, right, start, end, length: int) -> Column:
    """Bases of one linear interval inside the deleted arc; no arrays, so it code-generates."""
    left, right, start, end = _c(left), _c(right), _c(start), _c(end)
    forward = _shared(left + 1, F.when(right > left, right - 1).otherwise(F.lit(length)), start, end)
    head = F.when(right <= left, _shared(F.lit(1), right - 1, start, end)).otherwise(F.lit(0))
    return (forward + head).cast("int")


def wraps_origin(left, right) -> Column:
    return _c(right) <= _c(left)


def interval_text(left, right, length: int) -> Column:
    """``a-b`` or ``a-b;c-d`` text of the deleted pieces, empty when none."""
    left, right = _c(left), _c(right)
    wraps = right <= left

    def text(a, b):
        return F.concat(a.cast("string"), F.lit("-"), b.cast("string"))

    return F.concat_ws(
        ";",
        F.when(~wraps & (right - left > 1), text(left + 1, right - 1)),
        F.when(wraps & (left < length), text(left + 1, F.lit(length))),
        F.when(wraps & (right > 1), text(F.lit(1), right - 1)),
    )


def directed_record(left, right, length: int) -> dict[str, Column]:
    """The columns that describe a directed pair left -> right."""
    left, right = _c(left), _c(right)
    return {
        "deleted_size": directed_gap(left, right, length),
        "wraps_origin": wraps_origin(left, right),
        "deleted_interval": interval_text(left, right, length),
        "complement_deleted_size": directed_gap(right, left, length),
        "complement_wraps_origin": left <= right,
    }


def shortest_arc(left, right, length: int) -> Column:
    """struct(left, right, reversed) of the shorter arc; ties take the smaller pair."""
    left, right = _c(left), _c(right)
    forward, backward = directed_gap(left, right, length), directed_gap(right, left, length)
    swap = (backward < forward) | ((backward == forward) & (right < left))
    return F.struct(
        F.when(swap, right).otherwise(left).cast("int").alias("left"),
        F.when(swap, left).otherwise(right).cast("int").alias("right"),
        swap.alias("reversed"),
    )


def deletion_id(left, right, size) -> Column:
    """C11: directed event id."""
    return F.format_string("mtDel_%05d_%05d_%05d", _c(left), _c(right), _c(size))


def breakpoint_pair_id(left, right) -> Column:
    """C11: id of the unordered breakpoint pair."""
    left, right = _c(left), _c(right)
    return F.format_string("mtPair_%05d_%05d", F.least(left, right), F.greatest(left, right))


def size_class(size) -> Column:
    """Fixed size classes."""
    size = _c(size)
    return (
        F.when(size < 250, "small_lt_250bp")
        .when(size < 1000, "small_250bp_to_999bp")
        .when(size < 5000, "medium_1kb_to_4999bp")
        .when(size < 10000, "large_5kb_to_9999bp")
        .otherwise("very_large_ge_10kb")
    )


def within_window(pos, center, tolerance, length: int) -> Column:
    """Circular window membership."""
    return circular_distance(pos, center, length) <= _c(tolerance)


def unwrap(value, anchor, length: int) -> Column:
    """Place a position on the line around ``anchor`` (first half of C14)."""
    value, anchor = _c(value), _c(anchor)
    half = length // 2
    return anchor + F.pmod(value - anchor + half, F.lit(length)) - half


def wrap_median(unwrapped_median, length: int) -> Column:
    """Round an unwrapped median half to even and put it back on the circle (second half of C14)."""
    return normalize_pos(F.bround(_c(unwrapped_median).cast("double"), 0).cast("int"), length)


def circular_midpoint(left, right, length: int) -> Column:
    """Midpoint of the interval left..right, fractional."""
    left, right = _c(left), _c(right)
    end = F.when(right < left, right + length).otherwise(right)
    return F.pmod((left + end) / F.lit(2.0) - 1, F.lit(float(length))) + 1


def window_pieces(pos, radius, length: int) -> Column:
    """Closed pieces of the circular window around a position."""
    pos, radius = _c(pos), _c(radius)
    return region_pieces(normalize_pos(pos - radius, length), normalize_pos(pos + radius, length), length)


def block_pieces(start, end, length: int, rotation_start=1) -> Column:
    """Pieces of an aligned block after undoing the rotation."""
    return region_pieces(
        normalize_pos(start, length, rotation_start), normalize_pos(end, length, rotation_start), length
    )


def angle_degrees(pos, length: int) -> Column:
    """C17: clockwise angle of a position, 0 at coordinate 1."""
    return (_c(pos) - 1) / F.lit(float(length)) * 360


def rotate_text(text, start) -> Column:
    """Rotate a sequence so that it begins at 1-based ``start``."""
    text, start = _c(text), _c(start)
    return F.concat(text.substr(start, F.length(text)), text.substr(F.lit(1), start - 1))
