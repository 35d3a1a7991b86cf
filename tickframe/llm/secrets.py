"""Secret scan: fixed patterns and sliding-window entropy.

Base spans come from three patterns. The entropy pass looks at candidate
strings, maximal runs of one character class (hex, base64), and slides a
window over each: the counts of the characters in the window and the sum of
``c * log2(c)`` over them are updated by the character that enters and the
one that leaves, so a step's cost doesn't depend on the window. Windows
whose Shannon entropy, ``log2(width) - sum / width``, reaches the class's
threshold are merged into spans. A candidate that an allow-list pattern
matches wholly gives no entropy span; base spans always stay. All of it is
Spark column expressions on one row, without a shuffle.

Cases: a null text counts as empty and has no spans; every row, repeated or
with a null doc_id, has its own result row; an empty table gives none;
other columns play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_texts
from .spans import SPAN, count_of, joined, let, match_spans, ordered_by_start

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
# a maximal run, so that a start inside a run that is too short isn't tried
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"


@dataclass(frozen=True)
class CharClass:
    name: str
    alphabet: str
    pattern: str
    width: int
    bits: float  # entropy from which a window counts


HEX_CLASS = CharClass("entropy_hex", "0123456789abcdefABCDEF", r"(?<![0-9a-fA-F])[0-9a-fA-F]{20,}", 20, 3.0)
BASE64_CLASS = CharClass("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
                         r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}", 24, 4.0)
CLASSES = (HEX_CLASS, BASE64_CLASS)
KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))

#: Whole candidates that are not secrets: UUIDs, words without digits or
#: without letters, and strings that say they are examples.
ALLOW = (r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[^0-9]*", r"[^A-Za-z]*", r"(?i).*example.*")

_UNIT = 1 << 32  # c * log2(c) in fixed point: sums are exact


def base_spans(text: str = "text") -> Column:
    return F.concat(match_spans(text, ASSIGN, 0, lambda m, value: F.length(value) >= 12, group=2),
                    match_spans(text, ACCESS, 1), match_spans(text, HEX, 2))


def window_spans(candidate: Column, cls: CharClass) -> Column:
    """Merged windows of ``candidate`` with enough entropy, from its start."""
    w = cls.width
    weights = F.array(*(F.lit(round(k * math.log2(k) * _UNIT) if k else 0).cast("long") for k in range(w + 2)))
    most = int((math.log2(w) - cls.bits) * w * _UNIT)
    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(cls.alphabet), ch))
    steps = let(codes, lambda codes: F.arrays_zip(codes.alias("code"), F.slice(F.concat(F.array_repeat(F.lit(0), w), codes), F.lit(1), F.size(codes)).alias("gone")))
    weight = lambda count: F.element_at(weights, count + 1)
    zero = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
                    F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("from"), F.lit(-1).alias("to"), F.array().cast("array<struct<a:int,b:int>>").alias("runs"))

    def step(acc, x):
        code, gone = x["code"], x["gone"]  # gone is 0 until the window is full
        n_gone = F.element_at(acc["counts"], F.greatest(gone, F.lit(1)))
        n_code = F.element_at(acc["counts"], code) - F.when(code == gone, 1).otherwise(0)
        total = acc["sum"] + F.when(gone > 0, weight(F.greatest(n_gone, F.lit(1)) - 1) - weight(n_gone)).otherwise(F.lit(0).cast("long")) + weight(n_code + 1) - weight(n_code)
        end = acc["at"] + 1
        hit = (end >= w) & (total <= most)
        apart = hit & (acc["to"] < end - w)
        counts = F.transform(acc["counts"], lambda c, k: c + F.when(k + 1 == code, 1).otherwise(0) - F.when(k + 1 == gone, 1).otherwise(0))
        runs = F.when(apart & (acc["to"] >= 0), F.concat(acc["runs"], F.array(F.struct(acc["from"].alias("a"), acc["to"].alias("b"))))).otherwise(acc["runs"])
        return F.struct(end.alias("at"), counts.alias("counts"), total.alias("sum"),
                        F.when(apart, end - w).otherwise(acc["from"]).alias("from"), F.when(hit, end).otherwise(acc["to"]).alias("to"), runs.alias("runs"))

    last = lambda acc: F.when(acc["to"] >= 0, F.concat(acc["runs"], F.array(F.struct(acc["from"].alias("a"), acc["to"].alias("b"))))).otherwise(acc["runs"])
    return F.aggregate(steps, zero, step, last)


def entropy_spans(text: str = "text", classes=CLASSES, allow=ALLOW) -> Column:
    return F.concat(*(_entropy_spans(text, cls, kind, allow) for kind, cls in enumerate(classes, 3)))


def _entropy_spans(text: str, cls: CharClass, kind: int, allow) -> Column:
    none = F.array().cast("array<struct<a:int,b:int>>")

    def of(s):
        candidate = F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"])
        allowed = F.lit(False)
        for pattern in allow:
            allowed = allowed | candidate.rlike(f"^(?:{pattern})$")
        runs = F.when(allowed, none).otherwise(window_spans(candidate, cls))
        return F.transform(runs, lambda r: F.struct((s["start"] + r["a"]).alias("start"), (s["start"] + r["b"]).alias("end"), F.lit(kind).alias("kind")))

    return F.flatten(F.transform(match_spans(text, cls.pattern, kind), of)).cast(SPAN)


def scan(docs: DataFrame, classes=CLASSES, allow=ALLOW) -> DataFrame:
    """(doc_id, text, base, added): base spans and entropy spans of each row,
    as arrays of (start, end, kind number)."""
    return (whole_texts(docs).withColumn("base", ordered_by_start(base_spans()))
            .withColumn("added", entropy_spans(classes=classes, allow=allow)))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """(doc_id, text) with every span, merged where they overlap, replaced."""
    merged = F.aggregate(
        ordered_by_start(F.concat("base", "added")),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(
                F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"))),
        lambda acc: F.struct(acc["at"].alias("at"), acc["out"].alias("out")))
    return scan(docs).select("doc_id", "text", merged.alias("m")).select("doc_id", F.expr("concat(m.out, substring(text, m.at + 1))").alias("text"))


def report(scanned: DataFrame) -> DataFrame:
    return scanned.select("doc_id", *(count_of(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])),
                          F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                          joined(ordered_by_start(F.concat("base", "added")), KINDS).alias("spans"))
