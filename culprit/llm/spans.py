"""Spans of patterns in texts as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column) -> Column:
    """The sum up to and with each element of an array that is not empty."""

    def add(sofar: Column, v: Column) -> Column:
        return F.concat(sofar, F.array(F.coalesce(F.get(sofar, F.size(sofar) - 1), F.lit(0)) + v))

    return F.aggregate(values, F.array().cast("array<int>"), add)


def running_sums(values: Column) -> Column:
    """The sum up to and with each element, in blocks of about the square root of their number.

    An array grows by copying, so that one block of n elements would copy n² / 2.
    """

    def in_blocks(all_values: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_values))).cast("int")
        starts = F.sequence(F.lit(0), F.size(all_values) - 1, size)
        cut = F.transform(starts, lambda at: _running(F.slice(all_values, at + 1, size)))
        return bound(cut, with_earlier)

    def with_earlier(blocks: Column) -> Column:
        ends = _running(F.transform(blocks, lambda block: F.element_at(block, -1)))
        return bound(ends, lambda e: F.flatten(F.transform(blocks, lambda block, i: F.transform(block, lambda v: v + F.coalesce(F.get(e, i - 1), F.lit(0))))))

    return bound(values, in_blocks)


def with_matches(df: DataFrame, text: str, pattern: str, name: str, around: int = 0) -> DataFrame:
    """Add ``name``: an array of (start, end, found) for the leftmost non-overlapping matches.

    Places are code points from 0, the end exclusive. What lies between matches has lengths
    that, with those of the matches, add up to the places. With ``around`` a match also has
    ``before`` and ``after``: up to so many characters from the end or start of what lies
    between it and its neighbours, with these, and nothing is searched for in the whole text.
    """
    found, parts, steps, ends = f"_{name}_found", f"_{name}_parts", f"_{name}_steps", f"_{name}_ends"
    df = df.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    pieces = F.split(F.col(text), pattern, -1)
    df = df.withColumn(parts, F.when(F.size(found) > 0, pieces if around else F.transform(pieces, F.length)))
    gap = (lambda g: F.length(g)) if around else (lambda g: g)
    step = F.zip_with(found, F.slice(parts, 1, F.size(found)), lambda f, g: F.length(f) + gap(g))
    df = df.withColumn(steps, F.when(F.size(found) > 0, step))
    df = df.withColumn(ends, F.when(F.size(steps) > 0, running_sums(F.col(steps))))

    def place(f: Column, i: Column) -> Column:
        end = F.get(ends, i)
        fields = [(end - F.length(f)).alias("start"), end.alias("end"), f.alias("found")]
        if around:
            near = [F.coalesce(F.get(found, at), F.lit("")) for at in (i - 1, i + 1)]
            fields.append(F.right(F.concat(near[0], F.get(parts, i)), F.lit(around)).alias("before"))
            fields.append(F.left(F.concat(F.get(parts, i + 1), near[1]), F.lit(around)).alias("after"))
        return F.struct(*fields)

    more = ",before:string,after:string" if around else ""
    empty = F.array().cast(f"array<struct<start:int,end:int,found:string{more}>>")
    placed = F.transform(found, place)
    return df.withColumn(name, F.when(F.size(found) > 0, placed).otherwise(empty)).drop(found, parts, steps, ends)


def kept_as(matches: str, kind: str, order: int, keep: Callable[[Column], Column]) -> Column:
    """The matches whose text passes ``keep``, as (start, order, end, kind)."""
    good = F.filter(matches, lambda m: F.coalesce(keep(m["found"]), F.lit(False)))
    return F.transform(good, lambda m: span(m["start"], m["end"], kind, order))


def span(start: Column, end: Column, kind: str, order: int) -> Column:
    return F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"))


def written_out(spans: Column) -> Column:
    """kind:start:end of each span by start, then kind order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def first_at(spans: Column, passed: Callable[[Column], Column]) -> Column:
    """The first of the ordered spans that is ``passed``, found by halving; null where none is."""

    def halve(sofar: Column, _: Column) -> Column:
        middle = F.floor((sofar["low"] + sofar["high"]) / 2).cast("int")
        open_, yes = sofar["low"] < sofar["high"], passed(F.get(spans, middle))
        low = F.when(open_ & ~yes, middle + 1).otherwise(sofar["low"])
        return F.struct(low.alias("low"), F.when(open_ & yes, middle).otherwise(sofar["high"]).alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1.0))).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    return F.aggregate(steps, start, halve, lambda sofar: F.get(spans, sofar["low"]))


def overlaps(span: Column, others: Column) -> Column:
    """Whether one of ``others``, ordered and apart from each other, shares a place with the span."""
    return F.coalesce(first_at(others, lambda o: o["end"] > span["start"])["start"] < span["end"], F.lit(False))


def covers(span: Column, others: Column) -> Column:
    """Whether one of ``others``, ordered and apart from each other, lies in the span."""
    return F.coalesce(first_at(others, lambda o: o["start"] >= span["start"])["end"] <= span["end"], F.lit(False))


def apart_from(spans: str, others: list[str]) -> Column:
    """The spans that overlap none of the others, of which each column is ordered and apart."""
    out = F.col(spans)
    for other in others:
        out = F.when(F.size(other) > 0, _apart(out, F.col(other))).otherwise(out)
    return out


def _apart(spans: Column, other: Column) -> Column:
    return bound(other, lambda all_: F.filter(spans, lambda s: ~overlaps(s, all_)))


def without_repeats(spans: Column) -> Column:
    """The spans in order, equal ones once."""
    return bound(F.array_sort(spans), lambda all_: F.filter(all_, lambda s, i: F.coalesce(F.get(all_, i - 1) != s, F.lit(True))))
