"""Character spans of pattern matches as Spark columns.

Spark has the strings that a pattern matches and the pieces between them;
prefix sums of their lengths give every match's place in code points. Patterns must
not match the empty string. Java's possessive loops keep long texts from
using stack for each repetition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,kind:int>>"


#: Matches whose lengths are summed together on the way to their places.
BLOCK = 128


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def places(lens: Column, body) -> Column:
    """``body(at)``, where ``at(i)`` is the sum of the first i of ``lens``: whole
    blocks by their own prefix sums, the rest of a block one by one."""
    add = lambda a, x: a + x
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lens) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(lens, b * BLOCK + 1, BLOCK), F.lit(0), add))

    def with_before(sums):
        before = F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), add))
        return let(before, lambda known: body(lambda i: F.element_at(known, F.floor(i / BLOCK).cast("int") + 1)
                                              + F.aggregate(F.slice(lens, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK), F.lit(0), add)))

    return let(blocks, with_before)


def matches(text: str, pattern: str, kind: str, make, inner: int = 0) -> Column:
    """Array (of type ``kind``) of ``make(start, i, match, group, gaps)`` for
    the leftmost non-overlapping matches of ``pattern``; ``start`` counts code
    points, ``group`` is the match's group ``inner``, ``gaps[i]`` and
    ``gaps[i + 1]`` are the texts around match i."""
    none = F.array().cast(kind)

    def of_gaps(found, groups, gaps):
        lens = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        return let(lens, lambda lens: places(lens, lambda at: F.transform(found, lambda m, i: make(
            at(i) + F.length(F.element_at(gaps, i + 1)), i, m, F.element_at(groups, i + 1), gaps))))

    def of_found(found):
        groups = found if inner == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(inner))
        some = let(groups, lambda groups: let(F.split(text, pattern, -1), lambda gaps: of_gaps(found, groups, gaps)))
        return F.when(F.size(found) > 0, some).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of_found)


def match_spans(text: str, pattern: str, kind: int, keep=None, group: int = 0) -> Column:
    """Spans of the matches of ``pattern`` that pass ``keep(match, group)``."""
    found = matches(text, pattern, "array<struct<start:int,n:int,match:string,inner:string>>", lambda start, i, m, inner, gaps: F.struct(
        start.alias("start"), F.length(m).alias("n"), m.alias("match"), inner.alias("inner")), group)
    if keep is not None:
        found = F.filter(found, lambda x: F.coalesce(keep(x["match"], x["inner"]), F.lit(False)))
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["n"]).alias("end"), F.lit(kind).alias("kind"))).cast(SPAN)


def ordered_by_start(spans: Column) -> Column:
    """By start, then by kind as listed."""
    key = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(F.array_sort(key), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def ordered_by_kind(spans: Column) -> Column:
    """By kind as listed, then by start."""
    key = F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.transform(F.array_sort(key), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans, in their order, comma-joined."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
