"""Personal data: fixed patterns, and patterns learned from their contexts.

Base spans come from four patterns. They are the seeds of a bootstrap: each
white-space token that overlaps one is an instance, with digits or without.
The neighbouring words of an occurrence give its lexical patterns (the word
before; the words before and after). Patterns that enough seeds induce are
learned, every token of the corpus in one of these is a candidate, and the
pattern-instance graph is scored in rounds. Patterns with fewer seeds take
no part in a score, so leaving them out of the graph changes none; tokens
without a letter or digit name nothing and are words of a context only. A pattern's score is the share
of its distinct instances, weighted by their scores, that are personal
(smoothed, so that rare patterns score low); an instance's score is that of
its best pattern; seeds keep a score of 1. After the last round patterns
with a high score and enough seeds mark the unseen identifiers that occur in
them. Edges are counted before each shuffle, so a context or identifier
that fills the corpus is one row for each task.

All of it is DataFrame operations; the scored edges are staged as tables in
the shared folder. A bitmap of the learned patterns' hashes, of a fixed
size, passes through the driver, so that only tokens that may be candidates
become rows; a join with the patterns then decides.

Cases: a null text counts as empty and has no spans; every row, repeated or
with a null doc_id, has its own result row; an empty table gives none;
other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stage, whole_texts
from .spans import SPAN, count_of, joined, let, match_spans, ordered_by_kind, places

# Possessive forms of the contract's patterns: the same matches without
# backtracking. A local part starts after a character that can't belong to
# it, or where the match before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "context")

TOKEN = r"\S++"
#: Words of 64 bits in the bitmap of learned patterns.
BITMAP = 1 << 12
ROUNDS = 3
MIN_SEEDS = 5
MIN_SCORE = 0.8


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:|[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


def _luhn(m: Column) -> Column:
    digits = F.split(F.reverse(_digits(m)), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: str = "text") -> Column:
    return F.concat(
        match_spans(text, EMAIL, 0),
        match_spans(text, IP, 1, lambda m, _: _octets(m)),
        match_spans(text, CARD, 2, lambda m, _: F.length(_digits(m)).between(16, 19) & _luhn(m)),
        match_spans(text, PHONE, 3, lambda m, _: F.length(_digits(m)).between(8, 15)))


def _patterns(words: Column, i: Column) -> Column:
    """Patterns of the i-th token, counted from 1."""
    left = F.when(i > 1, F.element_at(words, F.greatest(i - 1, F.lit(1)))).otherwise("")
    right = F.when(i < F.size(words), F.element_at(words, F.least(i + 1, F.size(words)))).otherwise("")
    return F.array(F.concat(left, F.lit(" _")), F.concat_ws(" _ ", left, right))


def _words(found: Column) -> Column:
    return F.transform(found, lambda t: F.regexp_replace(F.lower(t), r"[^\p{L}]+", ""))


def _instance(token: Column) -> Column:
    return F.lower(F.regexp_replace(token, r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", ""))


def _tokens(kind: str, which, make) -> Column:
    """Array (of type ``kind``) of ``make(found, words)``'s results for the
    places in the list of tokens that ``which(found, words)`` gives."""
    none = F.array().cast(kind)

    def of_words(found, words):
        return let(which(found, words), lambda at: F.when(F.size(at) > 0, make(found, words, at)).otherwise(none))

    return let(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, let(_words(found), lambda words: of_words(found, words))).otherwise(none))


def _named(found: Column, i: Column) -> Column:
    return F.element_at(found, i).rlike(r"[\p{L}\p{N}]")


def _in_context(may_hold):
    return lambda found, words: F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: F.exists(_patterns(words, i), may_hold) & _named(found, i))


def _placed(found: Column, words: Column, which: Column) -> Column:
    """(start, end, token, patterns) of the tokens ``which``."""
    def of(gaps, at):
        def token(i):
            start = at(i - 1) + F.length(F.element_at(gaps, i))
            word = F.element_at(found, i)
            return F.struct(start.alias("start"), (start + F.length(word)).alias("end"), word.alias("token"), _patterns(words, i).alias("patterns"))
        return F.transform(which, token)
    lens = lambda gaps: F.zip_with(gaps, found, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
    return let(F.split("text", TOKEN, -1), lambda gaps: let(lens(gaps), lambda n: places(n, lambda at: of(gaps, at))))


def _occurrences(rows: DataFrame, which) -> DataFrame:
    """(doc_id, text_key, start, end, instance, seed, patterns) of the tokens
    ``which`` of (doc_id, text, base)."""
    tokens = _tokens("array<struct<start:int,end:int,token:string,patterns:array<string>>>", which, _placed)
    found = (rows.select("doc_id", F.xxhash64("text").alias("text_key"), "base", tokens.alias("tokens"))
             .select("doc_id", "text_key", "base", F.explode("tokens").alias("t")).select("doc_id", "text_key", "base", "t.*"))
    seed = F.exists("base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    return found.select("doc_id", "text_key", "start", "end", _instance(F.col("token")).alias("instance"), seed.alias("seed"), "patterns")


def _with_base(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base); every kind of base span holds a digit or an @."""
    return whole_texts(docs).withColumn("base", F.when(F.col("text").rlike("[0-9@]"), base_spans()).otherwise(F.array().cast(SPAN)))


def _bit(pattern: Column) -> Column:
    return F.pmod(F.xxhash64(pattern), F.lit(BITMAP * 64))


def _may_hold(patterns: DataFrame):
    """Test of a pattern: false only if it isn't in ``patterns``."""
    bits = patterns.select(_bit(F.col("pattern")).alias("bit")).distinct()
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    words = [0] * BITMAP
    for r in bits.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(one).alias("bits")).collect():  # BITMAP rows at most
        words[r["at"]] = r["bits"]
    bitmap = F.array(*(F.lit(w).cast("long") for w in words))
    held = lambda b: F.call_function("shiftright", F.element_at(bitmap, F.floor(b / 64).cast("int") + 1), (b % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    return lambda pattern: held(_bit(pattern))


def graph(docs: DataFrame, min_seeds: int = MIN_SEEDS) -> tuple[DataFrame, DataFrame]:
    """Edges (pattern, instance, seed) of every token of the corpus in a
    pattern that ``min_seeds`` seeds induce, and the seeds (instance)."""
    rows = _with_base(docs)
    # a token that has a letter or digit and overlaps a base span holds a digit or an @
    near = lambda found, words: F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: F.element_at(found, i).rlike("[0-9@]") & _named(found, i))
    induced = stage(_occurrences(rows.where(F.size("base") > 0), near).where("seed").select("instance", F.explode("patterns").alias("pattern")).distinct(), "pii-seeds")
    learned = stage(induced.groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= min_seeds).select("pattern"), "pii-learned")
    may_hold = _may_hold(learned)
    tokens = _tokens("array<struct<token:string,patterns:array<string>>>", _in_context(may_hold), lambda found, words, which: F.transform(
        which, lambda i: F.struct(F.element_at(found, i).alias("token"), F.filter(_patterns(words, i), may_hold).alias("patterns"))))
    found = whole_texts(docs).select(F.explode(tokens).alias("t")).select(F.col("t.token").alias("token"), F.explode("t.patterns").alias("pattern"))
    found = found.select("pattern", _instance(F.col("token")).alias("instance")).distinct().join(small(learned), "pattern", "left_semi")
    edges = found.join(induced.withColumn("seed", F.lit(1)), ["pattern", "instance"], "left").select("pattern", "instance", F.coalesce("seed", F.lit(0)).alias("seed"))
    return stage(edges, "pii-edges"), stage(induced.select("instance").distinct(), "pii-instances")


def score_patterns(edges: DataFrame, known: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(pattern, score, seeds) after ``rounds`` rounds over the graph;
    ``known`` are the instances that are seeds anywhere."""
    own = edges.select("instance").distinct().join(known.withColumn("own", F.lit(1.0)), "instance", "left")
    seeds = stage(own.select("instance", F.coalesce("own", F.lit(0.0)).alias("own")), "pii-own")
    scored = seeds.select("instance", F.col("own").alias("score"))
    patterns = None
    for _ in range(rounds):
        patterns = stage(edges.join(scored, "instance").groupBy("pattern")
                         .agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("score"), F.sum("seed").alias("seeds")), "pii-patterns")
        best = edges.join(patterns.where(F.col("seeds") >= min_seeds).select("pattern", "score"), "pattern").groupBy("instance").agg(F.max("score").alias("best"))
        scored = seeds.join(best, "instance", "left").select("instance", F.greatest("own", F.coalesce("best", F.lit(0.0))).alias("score"))
    return patterns


def extract(docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, text, base, added): base spans and the spans of discovered
    identifiers of each row, as arrays of (start, end, kind number)."""
    edges, known = graph(docs, min_seeds)
    good = score_patterns(edges, known, rounds, min_seeds).where((F.col("score") >= min_score) & (F.col("seeds") >= min_seeds)).select("pattern")
    good = stage(good, "pii-good")
    found = _occurrences(_with_base(docs), _in_context(_may_hold(good))).where(~F.col("seed"))
    added = (found.select("doc_id", "text_key", "start", "end", F.explode("patterns").alias("pattern"))
             .join(small(good), "pattern", "left_semi").groupBy("doc_id", "text_key")
             .agg(F.collect_set(F.struct("start", "end", F.lit(4).alias("kind"))).cast(SPAN).alias("added")))
    rows = _with_base(docs).withColumn("text_key", F.xxhash64("text"))
    added = added.withColumnsRenamed({"doc_id": "added_id", "text_key": "added_key"})
    return (rows.join(added, F.col("doc_id").eqNullSafe(F.col("added_id")) & (F.col("text_key") == F.col("added_key")), "left")
            .select("doc_id", "text", ordered_by_kind(F.col("base")).alias("base"), F.coalesce("added", F.array().cast(SPAN)).alias("added")))


def report(extracted: DataFrame) -> DataFrame:
    return extracted.select("doc_id", *(count_of(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
                            F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                            joined(ordered_by_kind(F.concat("base", "added")), KINDS).alias("spans"))
