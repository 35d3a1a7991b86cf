"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct words, A-Z lower-cased. A line is removed
if an earlier line of the corpus, by (doc_id, line number), has a Jaccard
similarity of at least ``threshold`` with it; lines are judged on the input,
blank lines never. Equal lines are brought together by hash first; the first
of each stands for all of them in the join.

Tokens are ordered by rarity: by the level of their count (over all lines,
in counters of hashed words). Two lines that are
similar share a token among the first ``n - ceil(threshold * n) + 1`` of
each. Among lines with a common prefix token, a pair also has to pass the
length filter and the positional filter, and of the bits that tell whether
the tokens hashed to them are odd in number, no more may differ than similar
lines differ in tokens. The join has two steps, so that a
group of near copies isn't paired with itself: each line is verified with
the earliest line of the groups of a few of its tokens; only lines that remain without a
partner are paired with all earlier lines of the groups of all their prefix
tokens, in a join whose two sides are one shuffle. One earlier
partner is all a line needs, so the steps together lose none.

All of it is DataFrame operations; only the counters, a fixed number, pass
through the driver.

Cases: null texts have no lines and stay null; rows without a doc_id keep
their text; different texts that share a doc_id are parts of one document, in
the order of their hashes, equal ones are one part and are treated alike; an empty table
gives an empty result; other columns are kept as they are (``n_chars``, if
there, follows the text).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, small, stage
from .spans import let

THRESHOLD = 0.75
COUNTERS = 1 << 18
#: Tokens by which a line meets the earliest of their groups.
LEADS = 4
#: Tokens up to which a line has one set of 64 bits.
FEW = 56
#: Tokens up to which it has two.
MANY = 120
_BITS = ("bits", "half", "other", "both")
#: Line numbers in lists by document up to which the lists are broadcast.
LISTED_LINES = 1_600_000

_SPACE = "\t\x0b\x0c\r"


def _plain(text: Column) -> Column:
    """A-Z lower-cased, white space but line ends as spaces; for comparing
    only. ``lower`` alone does it for ASCII. Other texts are read byte by byte
    as Latin-1 first: of a letter's bytes ``lower`` can only change the first,
    and as the others tell how many bytes it had, two letters stay two."""
    low = F.lower(F.when(F.octet_length(text) == F.length(text), text).otherwise(F.decode(text.cast("binary"), "ISO-8859-1")))
    for space in _SPACE:
        low = F.replace(low, F.lit(space), F.lit(" "))
    return low


def tokens(plain: Column) -> Column:
    return F.array_remove(F.split(plain, " "), "")


def _counter(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")


def rarity_levels(docs: DataFrame) -> list[int]:
    """log2 level of each counter's word count."""
    words = docs.select(F.explode(F.split(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("token")).where("token != ''")
    counts = words.groupBy(_counter(F.xxhash64("token")).alias("c")).count().toArrow()  # COUNTERS rows at most
    levels = np.zeros(COUNTERS, np.int64)
    levels[counts["c"].to_numpy()] = np.minimum(2 * np.log2(counts["count"].to_numpy()), 126).astype(np.int64) + 1
    return levels.tolist()


def _lines(docs: DataFrame, text: Column, *more: str) -> DataFrame:
    lines = (docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(_FIRST), *more, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line")))
    return lines.select("doc_id", (F.col("line_no") + F.col(_FIRST)).alias("line_no"), "line", *more)


#: Number of a text's first line in its document.
_FIRST = "first line of the text"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of each text's first line in its document: 0
    but for texts that share their doc_id with different ones."""
    hashed = F.xxhash64("text")
    named = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("shared_id"), hashed.alias("h"), F.size(F.split("text", "\n", -1)).cast("long").alias("n"))
    shared = named.groupBy("shared_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a != b").select("shared_id")
    parts = named.join(small(stage(shared, "lines-shared-ids")), "shared_id").distinct()
    before = Window.partitionBy("shared_id").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    first = stage(parts.select("shared_id", F.col("h").alias("shared_h"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shared_first")), "lines-shared")
    out = docs.join(small(first), (F.col("doc_id").cast("long") == F.col("shared_id")) & (hashed == F.col("shared_h")), "left")
    return out.select(*[docs[c] for c in docs.columns], F.coalesce("shared_first", F.lit(0)).cast("long").alias(_FIRST))


def _prefixes(docs: DataFrame, threshold: float) -> DataFrame:
    """(line_at, h, n, bits, half, other, both, prefix) of every line that isn't blank; ``line_at`` is its
    place in the corpus as one number, ``h`` the hash of its set, a bit of
    ``bits`` tells whether the tokens that hash to it are odd in number,
    ``half`` the same for one half of the tokens, of lines with more than ``FEW``;
    ``other`` for another half and ``both`` for what is in the two, of lines with more than ``MANY``;
    ``prefix`` has 31 bits of each token: a wrong match costs work, as lines are
    verified on their words."""
    levels = F.split(F.lit(",".join(map(str, rarity_levels(docs)))), ",").cast("array<long>")  # folded to one literal

    def key(t):
        h = F.xxhash64(t)
        return F.call_function("shiftleft", F.get(levels, _counter(h)), F.lit(48)) + F.call_function("shiftrightunsigned", h, F.lit(16))

    def bits(keys, of):
        return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.call_function("shiftleft", of(k), k.bitwiseAND(F.lit(63)).cast("int"))))

    def of_keys(keys):
        one = F.lit(1).cast("long")

        def part(more: int, of) -> Column:
            return F.when(F.size(keys) > more, bits(keys, of)).otherwise(F.lit(0).cast("long"))

        half, other = (lambda k, at=at: F.shiftright(k, at).bitwiseAND(one) for at in (6, 7))
        return F.struct(F.xxhash64(keys).alias("h"), F.size(keys).alias("n"), bits(keys, lambda k: one).alias("bits"), part(FEW, half).alias("half"),
                        part(MANY, other).alias("other"), part(MANY, lambda k: half(k).bitwiseAND(other(k))).alias("both"),
                        F.transform(F.slice(keys, F.lit(1), (F.size(keys) - F.ceil(F.size(keys) * threshold - 1e-9) + 1).cast("int")),
                                    lambda k: k.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("prefix"))

    lines = _lines(docs, _plain(F.col("text"))).where(F.trim("line") != "")
    return lines.select(_place(), let(F.sort_array(F.array_distinct(F.transform(tokens(F.col("line")), key))), of_keys).alias("k")).select("line_at", "k.*")


def _place() -> Column:
    """Place of a line as one number: 24 bits for the line in its document."""
    fits = (F.col("line_no") < 1 << 24) & (F.abs("doc_id") < 1 << 39)
    return F.when(fits, F.shiftleft(F.col("doc_id"), 24) + F.col("line_no")).otherwise(F.raise_error(F.lit("a doc_id of 2**39 or a text of 2**24 lines")).cast("long")).alias("line_at")


def similar_lines(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Every line that isn't blank (line_at, h), and for each distinct set of
    tokens h its first place, whether it occurs again, and whether an earlier
    line is similar to it."""
    wide = stage(_prefixes(docs, threshold), "lines-wide")
    every = stage(wide.select("line_at", "h"), "lines")
    first = stage(wide.groupBy("h").agg(F.min(F.struct("line_at", "n", *_BITS, "prefix")).alias("f"), (F.count(F.lit(1)) > 1).alias("again")).select("h", "again", "f.*"), "lines-first")
    release(wide)
    distinct_lines = stage(first.select("h", "line_at", "again"), "lines-distinct")

    def close(x: str, y: str) -> Column:
        nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
        differ = F.floor((nx + ny) * ((1 - threshold) / (1 + threshold)) + 1e-9)  # tokens in one line only, at most
        odd, half, other, both = (F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}")) for c in _BITS)
        halves = F.bit_count(half) + F.bit_count(odd.bitwiseXOR(half)) <= differ
        one, rest = other.bitwiseXOR(both), odd.bitwiseXOR(half)
        quarters = F.bit_count(both) + F.bit_count(half.bitwiseXOR(both)) + F.bit_count(one) + F.bit_count(rest.bitwiseXOR(one)) <= differ
        return ((F.least(nx, ny) >= F.greatest(nx, ny) * threshold - 1e-9) & (F.bit_count(odd) <= differ)
                & ((F.least(nx, ny) <= FEW) | halves) & ((F.least(nx, ny) <= MANY) | quarters))

    some = F.slice(F.sort_array("prefix"), 1, LEADS)
    group = Window.partitionBy("token")  # spills
    entry = first.select(F.explode(some).alias("token"), "line_at", "n", *_BITS).withColumn("lead", F.min(F.struct("line_at", "n", *_BITS)).over(group))
    entry = entry.where((F.col("line_at") != F.col("lead.line_at")) & close("", "lead."))
    done = _verified(docs, stage(entry.select("line_at", F.col("lead.line_at").alias("other")).distinct(), "lines-pairs"), threshold)

    # both sides of the join are one exchange: they have the same columns, and all
    # that differs by side is left to its condition. A p below 0 marks what is done
    done_at = F.col("done_at").isNotNull()
    entry = first.join(small(done.withColumnRenamed("line_at", "done_at")), F.col("line_at") == F.col("done_at"), "left").select(
        F.posexplode("prefix").alias("at", "token"), done_at.alias("is_done"), "line_at", "n", *_BITS)
    entry = entry.select("token", F.when(F.col("is_done"), -1 - F.col("at")).otherwise(F.col("at")).alias("p"), "line_at", "n", *_BITS)
    entry = entry.select(*(F.coalesce(c, F.lit(0)).alias(c) for c in entry.columns))
    x, y = (entry.select(*(F.col(c).alias(f"{s}_{c}") for c in entry.columns)) for s in "xy")
    nx, ny = F.col("x_n"), F.col("y_n")
    px, py = (F.when(F.col(c) < 0, -1 - F.col(c)).otherwise(F.col(c)) for c in ("x_p", "y_p"))
    need = F.ceil((nx + ny) * (threshold / (1 + threshold)) - 1e-9)
    before = F.when(F.col("x_p") < 0, F.lit(-(1 << 63))).otherwise(F.col("x_line_at"))
    may_match = (F.col("y_line_at") < before) & (1 + F.least(nx - px - 1, ny - py - 1) >= need) & close("x_", "y_")
    pairs = x.join(y, (F.col("x_token") == F.col("y_token")) & may_match)
    pairs = stage(pairs.select(F.col("x_line_at").alias("line_at"), F.col("y_line_at").alias("other")).distinct(), "lines-pairs")
    release(first)
    rest = _verified(docs, pairs, threshold)
    similar = done.unionByName(rest).withColumn("similar", F.lit(True))  # no line is in both
    places = distinct_lines.join(similar, "line_at", "left").withColumnRenamed("line_at", "first_at")
    return every, places.withColumn("similar", F.coalesce("similar", F.lit(False)))


def _verified(docs: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The line_at of ``pairs`` (line_at, other; staged, read once) whose
    lines are similar. Texts move, not their tokens' hashes: they compress."""
    used = pairs.select("line_at").union(pairs.select("other")).distinct()
    used = stage(used.groupBy(F.shiftright("line_at", 24).alias("used_id")).agg(F.collect_set(_line_no()).alias("used_lines")), "lines-used")
    within = docs.join(_small_lists(used, "used_lines"), F.col("doc_id").cast("long") == F.col("used_id"))
    texts = _lines(within, _plain(F.col("text")), "used_lines").where(F.array_contains("used_lines", F.col("line_no"))).select(_place(), "line")
    texts = stage(texts.dropDuplicates(["line_at"]), "lines-texts")
    both = pairs.join(texts.withColumnsRenamed({"line_at": "other", "line": "theirs"}), "other").join(texts.withColumnRenamed("line", "mine"), "line_at")
    both = both.select("line_at", *(F.array_distinct(tokens(F.col(c))).alias(c) for c in ("mine", "theirs")))
    common = F.size(F.array_intersect("mine", "theirs"))
    found = stage(both.where(common >= (F.size("mine") + F.size("theirs")) * (threshold / (1 + threshold)) - 1e-9).select("line_at").distinct(), "lines-similar")
    for read in (pairs, used, texts):
        release(read)
    return found


def _line_no() -> Column:
    return F.col("line_at").bitwiseAND(F.lit((1 << 24) - 1))


def _small_lists(lists: DataFrame, column: str) -> DataFrame:
    """As ``small``, for a staged table of lists: all their elements count."""
    n = lists.select(F.sum(F.size(column))).first()[0] or 0
    return F.broadcast(lists) if n <= LISTED_LINES else lists


def remove_repeated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the lines removed, and ``n_lines`` and ``n_removed``."""
    columns = docs.columns
    docs = _numbered(docs)
    every, places = similar_lines(docs, threshold)
    # lines that occur once and are like no other need no join
    places = places.where(F.col("again") | F.col("similar"))
    gone = every.join(small(stage(places, "lines-places")), "h").where(F.col("similar") | (F.col("line_at") != F.col("first_at")))
    gone = gone.select(F.shiftright("line_at", 24).alias("removed_id"), _line_no().alias("line_no"))
    gone = stage(gone.groupBy("removed_id").agg(F.collect_set("line_no").alias("removed_lines")), "lines-removed")
    joined = docs.join(_small_lists(gone, "removed_lines"), F.col("doc_id") == F.col("removed_id"), "left")
    lines, first = F.split("text", "\n", -1), F.col(_FIRST)
    own = F.sequence(first, first + F.size(lines) - 1)
    rest = let(lines, lambda one: F.transform(F.array_except(own, F.col("removed_lines")), lambda i: F.element_at(one, (i - first + 1).cast("int"))))
    text = F.when(F.col("removed_lines").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    n_removed = F.coalesce(F.size(F.array_intersect(own, F.col("removed_lines"))), F.lit(0))
    out = joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in columns],
                        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out


def drop_emptied(cleaned: DataFrame) -> DataFrame:
    """``remove_repeated`` output without the documents that lost lines and
    have nothing but white space left: copies of earlier ones. Documents that
    were empty before stay."""
    return cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))


def report(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
