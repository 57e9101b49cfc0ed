"""Geometry of boxes [x1, y1, x2, y2] as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE_WIDTH, PAGE_HEIGHT = 1654, 2338


def _at(box: Column, i: int) -> Column:
    return F.get(box, F.lit(i))


def width(box: Column) -> Column:
    return F.greatest(F.lit(0.0), _at(box, 2) - _at(box, 0))


def height(box: Column) -> Column:
    return F.greatest(F.lit(0.0), _at(box, 3) - _at(box, 1))


def area(box: Column) -> Column:
    return width(box) * height(box)


def intersection(a: Column, b: Column) -> Column:
    """Common area; 0 for boxes apart, null without two boxes."""
    w = F.least(_at(a, 2), _at(b, 2)) - F.greatest(_at(a, 0), _at(b, 0))
    h = F.least(_at(a, 3), _at(b, 3)) - F.greatest(_at(a, 1), _at(b, 1))
    return F.when((F.size(a) == 4) & (F.size(b) == 4), F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, the union at least 1."""
    common = intersection(a, b)
    return common / F.greatest(F.lit(1.0), area(a) + area(b) - common)


def overlap_of_smaller(a: Column, b: Column) -> Column:
    return intersection(a, b) / F.greatest(F.lit(1.0), F.least(area(a), area(b)))


def containment(inner: Column, outer: Column) -> Column:
    """Share of inner that lies in outer."""
    return intersection(inner, outer) / F.greatest(F.lit(1.0), area(inner))


def center_y(box: Column) -> Column:
    return (_at(box, 1) + _at(box, 3)) / 2


def valid_box(box: Column, page_width: Column | None = None, page_height: Column | None = None) -> Column:
    """Four finite numbers, in order, within the page; a null or zero page size is the default page's. Never null."""
    w = F.coalesce(F.when(page_width != 0, page_width), F.lit(PAGE_WIDTH)) if page_width is not None else F.lit(PAGE_WIDTH)
    h = F.coalesce(F.when(page_height != 0, page_height), F.lit(PAGE_HEIGHT)) if page_height is not None else F.lit(PAGE_HEIGHT)
    finite = F.forall(box, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    inside = (_at(box, 0) >= 0) & (_at(box, 0) < _at(box, 2)) & (_at(box, 2) <= w) & (_at(box, 1) >= 0) & (_at(box, 1) < _at(box, 3)) & (_at(box, 3) <= h)
    return F.coalesce((F.size(box) == 4) & finite & inside, F.lit(False))


def region_reasons(box: Column, page: Column, expected_page: Column, page_width: Column, page_height: Column) -> Column:
    """Ordered reason codes against a region: not a box, another page, over 60 % of the page, out of bounds."""
    share = area(box) / F.greatest(F.lit(1.0), page_width * page_height)
    shaped = F.coalesce((F.size(box) == 4) & F.forall(box, lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(False))
    outside = (_at(box, 0) < 0) | (_at(box, 1) < 0) | (_at(box, 2) > page_width) | (_at(box, 3) > page_height)
    return F.array_compact(F.array(
        F.when(~shaped | (width(box) <= 0) | (height(box) <= 0), "INVALID_BOX"),
        F.when(~page.eqNullSafe(expected_page), "WRONG_PAGE"),
        F.when(shaped & (share > 0.6), "TOO_LARGE"),
        F.when(shaped & outside, "OUT_OF_BOUNDS"),
    ))


def scaled(box: Column, from_size: tuple[Column, Column], to_size: tuple[Column, Column]) -> Column:
    """Box in another page size, each side rounded half to even."""
    fx, fy = to_size[0] / from_size[0], to_size[1] / from_size[1]
    return F.array(*[F.bround(_at(box, i) * (fx if i % 2 == 0 else fy)) for i in range(4)])


def transposed(box: Column) -> Column:
    """[y1, x1, y2, x2] to [x1, y1, x2, y2] and back."""
    return F.array(*[_at(box, i) for i in (1, 0, 3, 2)])


def clamped(value: Column, limit: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(-limit), F.least(F.lit(limit), value)))


def shifted(box: Column, dx: Column, dy: Column, dw: Column, dh: Column, limit: float = 80.0) -> Column:
    """Box moved by dx, dy and grown by dw, dh, each within the limit."""
    dx, dy, dw, dh = (clamped(v, limit) for v in (dx, dy, dw, dh))
    return F.array(_at(box, 0) + dx, _at(box, 1) + dy, _at(box, 2) + dx + dw, _at(box, 3) + dy + dh)


def cells(box: Column, size: float) -> Column:
    """Numbers (x, y) of the grid cells a box touches, for equi-joins of boxes that may overlap."""
    def span(lo: Column, hi: Column) -> Column:
        first = F.floor(lo / size)
        return F.sequence(first, F.greatest(first, F.floor(hi / size)))

    return F.flatten(F.transform(span(_at(box, 0), _at(box, 2)), lambda x: F.transform(span(_at(box, 1), _at(box, 3)), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def slot_reasons(box: Column, kind: Column, page_width: Column, page_height: Column) -> Column:
    """Reason codes of a slot's size by kind: most share of the page's width, and of its area."""
    limits = {"choice": (0.35, 0.10), "fill": (0.58, 0.20), "large": (0.94, 0.68)}
    pick = lambda i: reduce(lambda c, k: c.when(kind == k, limits[k][i]), limits, F.when(F.lit(False), 0.0)).otherwise((0.82, 0.45)[i])
    return F.array_compact(F.array(
        F.when(width(box) > page_width * pick(0), "TOO_WIDE"),
        F.when(area(box) > page_width * page_height * pick(1), "TOO_LARGE"),
    ))


def shared_height(a: Column, b: Column) -> Column:
    """Share of the lower box's height that both have."""
    common = F.greatest(F.lit(0.0), F.least(_at(a, 3), _at(b, 3)) - F.greatest(_at(a, 1), _at(b, 1)))
    return common / F.greatest(F.lit(1.0), F.least(height(a), height(b)))


def in_region(block: Column, region: Column, least: float = 0.5) -> Column:
    """Whether a block lies in a region by its centre or by that share of its area."""
    inside = ((_at(block, 0) + _at(block, 2)) / 2).between(_at(region, 0), _at(region, 2)) & center_y(block).between(_at(region, 1), _at(region, 3))
    return (containment(block, region) >= least) | inside


def too_broad(box: Column, page_width: Column, page_height: Column) -> Column:
    """Whether a region is over 60 % of the page, or over 90 % of its width and 40 % of its height."""
    w, h = width(box) / page_width, height(box) / page_height
    return (w * h > 0.6) | ((w > 0.9) & (h > 0.4))


def split_down(box: Column, parts: int, page_height: Column) -> Column:
    """The box, cut off at the page's end, in parts of one height from the top; none if nothing is left."""
    bottom = F.least(_at(box, 3), page_height)
    step = (bottom - _at(box, 1)) / parts
    part = lambda i: F.array(_at(box, 0), F.round(_at(box, 1) + i * step, 2), _at(box, 2), F.round(bottom if i + 1 == parts else _at(box, 1) + (i + 1) * step, 2))
    return F.when(bottom > _at(box, 1), F.array(*[part(i) for i in range(parts)]))


def union_all(box: Column) -> Column:
    """Aggregate: the least box around all."""
    return F.array(F.min(_at(box, 0)), F.min(_at(box, 1)), F.max(_at(box, 2)), F.max(_at(box, 3)))


def upper_median(value: Column) -> Column:
    """Aggregate: the middle value, of two the upper one. A group's values are one array: a page's worth."""
    all_ = F.array_sort(F.collect_list(value))
    return F.get(all_, F.floor(F.size(all_) / 2).cast("int"))


def hard_gate(box: Column, kind: Column, roi_width: Column, roi_height: Column, corridor: Column | None = None, stem: Column | None = None, other_stems: Column | None = None, diagrams: Column | None = None, siblings: Column | None = None) -> Column:
    """Ordered reason codes against a slot's box in its question's region; what is not given speaks against nothing.

    In the region; by kind its area and sides; its centre in the question's corridor; how much it covers of the stem,
    of other questions' stems (arrays of boxes, as all that follow), of diagrams of itself, and of its siblings.
    """
    choice = F.coalesce(kind == "choice", F.lit(False))
    shaped = F.coalesce((F.size(box) == 4) & (_at(box, 0) >= 0) & (_at(box, 1) >= 0) & (_at(box, 0) < _at(box, 2)) & (_at(box, 1) < _at(box, 3)) & (_at(box, 2) <= roi_width) & (_at(box, 3) <= roi_height), F.lit(False))
    ratio = area(box) / F.greatest(F.lit(1.0), roi_width * roi_height)
    any_of = lambda found, test: F.lit(False) if found is None else F.coalesce(F.exists(found, test), F.lit(False))
    share = lambda a, of: F.coalesce(F.try_divide(intersection(a, box), area(of)), F.lit(0.0))
    outside = F.lit(False) if corridor is None else ~(((_at(box, 0) + _at(box, 2)) / 2).between(_at(corridor, 0), _at(corridor, 2)) & center_y(box).between(_at(corridor, 1), _at(corridor, 3)))
    reasons = F.array_compact(F.array(
        F.when(ratio > F.when(choice, 0.035).otherwise(0.12), "box_area_too_large"),
        F.when(choice & ((width(box) > 0.22 * roi_width) | (height(box) > 0.12 * roi_height)), "choice_box_not_local"),
        F.when(~choice & (height(box) > 0.32 * roi_height), "answer_box_too_tall"),
        F.when(outside, "outside_question_corridor"),
        F.when(F.lit(False) if stem is None else share(stem, stem) > 0.62, "covers_printed_stem"),
        F.when(any_of(other_stems, lambda o: share(o, o) > 0.45), "crosses_other_question_stem"),
        F.when(any_of(diagrams, lambda d: share(d, box) >= 0.30), "overlaps_diagram_mask"),
        F.when(any_of(siblings, lambda o: F.coalesce(F.try_divide(intersection(o, box), F.least(area(o), area(box))), F.lit(0.0)) >= 0.55), "duplicates_sibling_slot"),
    ))
    return F.when(shaped, reasons).otherwise(F.array(F.lit("invalid_or_out_of_bounds")))
