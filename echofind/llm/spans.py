"""Where regular expressions match, with built-in functions only.

Offsets are code points, ends exclusive. A match list comes from
``regexp_extract_all`` and its offsets from the gaps that ``split`` leaves between
the matches, so both see the same leftmost, non-overlapping matches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), use)[0]


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an int array, in blocks of about the root of its size: n**1.5 copies, not n**2."""

    def sums(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["out"], a["sum"] + x).alias("out")))["out"]

    def blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(v), width), lambda i: sums(F.slice(v, i, width)))

    def joined(parts: Column) -> Column:
        ends = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        return bound(ends, lambda e: F.flatten(F.transform(parts, lambda p, b: F.transform(p, lambda x: x + F.when(b == 0, 0).otherwise(F.get(e, b - 1))))))

    return bound(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(bound(blocks(v), joined)))


def matches(text: Column, kind: str, pattern: str, valid: Callable[[Column], Column] | None = None, score: Callable[[Column, Column], Column] | float = 1.0, group: int = 0, holding: tuple[str, ...] = ()) -> Column:
    """Spans of ``pattern`` in ``text``; ``value`` is the match, or its ``group`` where one is given.

    ``holding`` names strings of which every match has one: a text without any of them is not searched.

    ``valid`` takes the value and drops failing matches, without a retry at another
    place. ``score`` is a number or takes the value and the 60 code points before the match.
    """

    def spans(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

        def build(g: Column, v: Column) -> Column:
            steps = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(g, i)))
            ends = running_sums(steps)

            def one(end: Column, i: Column) -> Column:
                value = F.get(v, i)
                rated = score(value, F.right(F.get(g, i), F.lit(60))) if callable(score) else F.lit(float(score))
                return F.struct(
                    F.lit(kind).alias("kind"), (end - F.length(F.get(found, i))).alias("start"), end.alias("end"), value.alias("value"), rated.alias("score")
                )

            return F.transform(ends, one)

        out = bound(F.struct(gaps.alias("g"), values.alias("v")), lambda s: build(s["g"], s["v"]))
        return F.when(F.size(found) == 0, F.array().cast(SPAN)).otherwise(F.filter(out, lambda s: valid(s["value"])) if valid else out)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if holding:
        held = reduce(lambda x, y: x | y, [F.contains(text, F.lit(part)) for part in holding])
        found = F.when(~held, F.array().cast("array<string>")).otherwise(found)
    return bound(found, spans).cast(SPAN)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def by_start(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans ordered by start, then by the place of their kind in ``kinds``."""
    order = F.array(*map(F.lit, kinds))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans (ordered by start) replaced by ``[kind]`` of its first."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        cut = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), s["kind"], F.lit("]"))))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), cut.alias("out"))

    done = bound(F.aggregate(spans, start, step), lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)
