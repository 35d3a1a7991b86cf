"""Phrase collocations per language, counted in quotient filters.

1. Each slice of texts becomes a row of word codes, 0 between pieces, with
   its own dictionary; words are counted by (lang, word) and those that
   occur ``min_count`` times get a number. A phrase can't be frequent if one
   of its words isn't, so other words end a run of codes like a break does.
2. For 2, 3, ... words: each task fills counting quotient filters
   (``quotient``) from its rows, cut in parts by leading quotient bits; the
   filters of a part are merged like sorted runs. An n-gram is counted only
   where its first and its last n-1 words are frequent, which a bitmap of
   bounded size tells: a wrong yes of the bitmap costs work, never a count.
3. Cuts, scores and cover are joins over the frequent phrases alone, in
   decimals of 38 digits.

The number of parts grows with the word count; beyond 1,024 parts filters
are dealt in rounds of 10 bits, so neither a row nor a task grows with the
corpus. A phrase that makes up a third of all words is one entry a shard.

Cases: a null text is empty; a null lang is ``und``, like that name itself;
texts without words and an empty table give no rows; repeated rows count
each time; other columns, whatever their names, play no part; a text longer
than a slice is a slice of its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quotient
from .bytewords import byte_words
from .common import release, small, stage
from .shingles import mix, slices

_U = np.uint64
MIN_COUNT, MAX_WORDS, COVER, TOP = 100, 5, 100, 2000
#: n-grams a task holds before it writes them as filters, entries a merge holds, and entries meant for one part.
SHARD_GRAMS, MERGE_ENTRIES, PART_GRAMS = 2 << 20, 4 << 20, 1 << 20
ROUND_BITS = 10
#: Bits of the bitmap of frequent phrases: 16 for each, within these bounds.
LEAST_BITMAP, MOST_BITMAP = 1 << 16, 1 << 28

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

_CODED = "slice long, lang string, width int, codes binary, words array<string>, counts array<long>, n long"
_FILTER = "lang string, part long, filter binary"
_PHRASE = "lang string, ids array<long>, f long, spot long"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts in order, and for each the number
    of its piece; pieces never cross texts."""
    words, starts, kind, offsets = byte_words(texts, _KIND)
    if len(starts) == 0:
        return words, starts
    return words, np.cumsum(kind == 2)[starts] + np.searchsorted(offsets, starts, "right")


def _coded(batches):
    """Rows of local codes (from 1; 0 ends a piece), one for each slice and language."""
    task, k = TaskContext.get().partitionId(), 0
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for first, last in slices(texts):
            part, names = texts.slice(first, last - first), langs.slice(first, last - first)
            for lang in pc.unique(names).to_pylist():
                words, piece = words_of(part.filter(pc.equal(names, lang)))
                if len(words) == 0:
                    continue
                own = words.dictionary_encode()
                codes = own.indices.to_numpy() + 1
                ends = np.flatnonzero(np.diff(piece)) + 1
                width = 2 if len(own.dictionary) < 1 << 16 else 4
                coded = np.insert(codes, ends, 0).astype(f"<u{width}").tobytes()
                known, counts = own.dictionary.cast(pa.string()), pa.array(np.bincount(codes)[1:], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + k], pa.int64()), pa.array([lang], pa.string()), pa.array([width], pa.int32()), pa.array([coded], pa.binary()),
                     pa.ListArray.from_arrays([0, len(known)], known), pa.ListArray.from_arrays([0, len(counts)], counts),
                     pa.array([len(codes)], pa.int64())], ["slice", "lang", "width", "codes", "words", "counts", "n"])
                k += 1


def _numbered(batches):
    """Local codes as numbers of frequent words; 0 for others and between pieces."""
    for batch in batches:
        for lang, width, codes, known in zip(*(batch.column(c) for c in ("lang", "width", "codes", "known")), strict=True):
            local = np.frombuffer(codes.as_py(), f"<u{width.as_py()}")
            pairs = known.values
            table = np.zeros(int(local.max()) + 1, "<u8")
            table[pairs.field("code").to_numpy(zero_copy_only=False)] = pairs.field("id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()], pa.string()), pa.array([table[local].tobytes()], pa.binary())], ["lang", "ids"])


def _salt(lang: str) -> np.uint64:
    return mix(np.array([zlib.crc32(lang.encode()) + 1], _U))[0]


def _spots(lang: str, columns: list[np.ndarray]) -> np.ndarray:
    spot = np.full(len(columns[0]), _salt(lang), _U)
    for c in columns:
        spot = mix(spot + c)
    return spot


def _present(ids: np.ndarray, n: int) -> np.ndarray:
    """Is there a frequent word at each of the ``n`` places from here on?"""
    there = ids != 0
    out = there[:max(len(ids) - n + 1, 0)].copy()
    for j in range(1, n):
        out &= there[j:len(out) + j]
    return out


def _grams(lang: str, ids: np.ndarray, n: int, bits: int, bitmap: np.ndarray | None) -> list[np.ndarray]:
    """Permuted, packed n-grams whose (n-1)-grams may be frequent."""
    keep = _present(ids, n)
    if bitmap is not None:
        part = _present(ids, n - 1)
        at = np.flatnonzero(part)
        spot = _spots(lang, quotient.pack(quotient.permute([ids[at + j] for j in range(n - 1)], bits), bits)) & _U(8 * len(bitmap) - 1)
        part[at] = bitmap[(spot >> _U(3)).astype(np.int64)] >> (spot & _U(7)).astype(np.uint8) & 1
        keep &= part[:len(keep)] & part[1:len(keep) + 1]
    at = np.flatnonzero(keep)
    return quotient.pack(quotient.permute([ids[at + j] for j in range(n)], bits), bits)


def _rows(lang: str, columns: list[np.ndarray], counts: np.ndarray, width: int, part_bits: int):
    """Filters of ascending n-grams, one for each part."""
    parts = quotient.parts_of(columns, part_bits)
    cuts = np.concatenate([[0], np.flatnonzero(parts[1:] != parts[:-1]) + 1, [len(parts)]]) if len(parts) else np.zeros(1, np.int64)
    names = [int(parts[a]) for a in cuts[:-1]]
    raw = [quotient.write([c[a:b] for c in columns], counts[a:b], width, p, part_bits) for a, b, p in zip(cuts[:-1], cuts[1:], names, strict=True)]
    if raw:
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(raw), pa.string()), pa.array(names, pa.int64()), pa.array(raw, pa.binary())], ["lang", "part", "filter"])


def _shards(n: int, bits: int, part_bits: int, bitmap):
    """Task: numbered rows to filters of their n-grams."""

    def tasks(batches):
        spots = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None
        held: dict[str, list] = {}
        total = 0

        def flush():
            for lang, grams in held.items():
                columns, counts = quotient.count([np.concatenate(c) for c in zip(*grams, strict=True)])
                yield from _rows(lang, columns, counts, n * bits, part_bits)
            held.clear()

        for batch in batches:
            for lang, ids in zip(batch.column("lang").to_pylist(), batch.column("ids"), strict=True):
                grams = _grams(lang, np.frombuffer(ids.as_py(), "<u8"), n, bits, spots)
                held.setdefault(lang, []).append(grams)
                total += len(grams[0])
                if total >= SHARD_GRAMS:
                    yield from flush()
                    total = 0
        yield from flush()

    return tasks


def _merged(n: int, bits: int, part_bits: int, finish):
    """Task: filters sorted by lang and part, merged; ``finish(lang, columns,
    counts)`` gives the output of a part, or of as much of it as is held."""

    def tasks(batches):
        def total(held):
            return quotient.count([np.concatenate(c) for c in zip(*(h[0] for h in held), strict=True)], np.concatenate([h[1] for h in held]))

        now, held, size = None, [], 0
        for batch in batches:
            for lang, part, raw in zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist(), batch.column("filter"), strict=True):
                if (lang, part) != now and held:
                    yield from finish(now[0], *total(held))
                    held, size = [], 0
                now = (lang, part)
                held.append(quotient.read(raw.as_py(), part, part_bits))
                size += len(held[-1][1])
                if size > MERGE_ENTRIES:
                    held = [total(held)]
                    size = len(held[0][1]) // 2
        if held:
            yield from finish(now[0], *total(held))

    return tasks


def _frequent(filters: DataFrame, n: int, bits: int, rounds: list[int], min_count: int) -> DataFrame:
    """(lang, ids, f, spot) of the n-grams that occur ``min_count`` times,
    from filters cut by the first of ``rounds`` (numbers of leading bits)."""

    def keep(lang, columns, counts):
        often = counts >= min_count
        columns, counts = [c[often] for c in columns], counts[often]
        ids = np.stack(quotient.restore(quotient.unpack(columns, n, bits), bits), 1).astype(np.int64)
        at = np.arange(0, ids.size + 1, n, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.ListArray.from_arrays(at, pa.array(ids.ravel())), pa.array(counts),
                                          pa.array(_spots(lang, columns).view(np.int64))], ["lang", "ids", "f", "spot"])

    for now, then in zip(rounds, [*rounds[1:], None], strict=True):
        dealt = filters.repartition("lang", "part").sortWithinPartitions("lang", "part")
        if then is None:
            return dealt.mapInArrow(_merged(n, bits, now, keep), _PHRASE)
        filters = dealt.mapInArrow(_merged(n, bits, now, lambda lang, c, k, then=then: _rows(lang, c, k, n * bits, then)), _FILTER)


def _bitmap(phrases: DataFrame):
    """Broadcast bitmap of the phrases' spots, of at most ``MOST_BITMAP``
    bits whatever their number, or None if there are none."""
    spark, n = phrases.sparkSession, phrases.count()
    if n == 0:
        return None
    size = min(max(1 << (16 * n).bit_length(), LEAST_BITMAP), MOST_BITMAP)
    spot = F.col("spot").bitwiseAND(F.lit(size - 1))
    found = (phrases.groupBy(F.shiftright(spot, 15).alias("at")).agg(F.bitmap_construct_agg(spot.bitwiseAND(F.lit(32767))).alias("bits")).collect())
    out = np.zeros(size // 8, np.uint8)
    for row in found:
        out[row["at"] * 4096:(row["at"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact counts of all phrases of up to ``max_words`` words that occur
    at least ``min_count`` times: (lang, ids, f), the words behind the ids
    (id, word), and all word occurrences by language (lang, n)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    coded = stage(texts.mapInArrow(_coded, _CODED), "phrases-coded")
    totals = stage(coded.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    local = coded.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w"))
    often = local.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).where(F.col("f") >= min_count)
    words = stage(often.withColumn("at", F.monotonically_increasing_id()), "phrases-words")
    # dense numbers from 1: a base for each partition that wrote words, one row a partition
    split = F.shiftright("at", 33)
    bases = (words.groupBy(split.alias("task")).agg(F.count("*").alias("k"))
             .select("task", (F.sum("k").over(Window.orderBy("task")) - F.col("k")).alias("base")))
    words = stage(words.join(F.broadcast(bases), split == F.col("task"))
                  .select("lang", "word", "f", (F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("id")), "phrases-words")
    bits = max(words.count().bit_length(), 1)
    ids = local.join(small(words.select("lang", F.col("word"), "id")).alias("v"), (F.col("w.words") == F.col("word")) & (local["lang"] == F.col("v.lang")))
    known = ids.groupBy("slice").agg(F.collect_list(F.struct((F.col("code") + 1).alias("code"), "id")).alias("known"))
    numbered = stage(coded.select("slice", "lang", "width", "codes").join(known, "slice").select("lang", "width", "codes", "known")
                     .mapInArrow(_numbered, "lang string, ids binary"), "phrases-numbered")
    release(coded)
    most = totals.agg(F.max("n")).first()[0] or 0
    levels = [words.select("lang", F.array("id").alias("ids"), "f")]
    bitmap = None
    for n in range(2, max_words + 1):
        need = min((most // PART_GRAMS).bit_length(), n * bits, 40)
        rounds = [*range(ROUND_BITS, need, ROUND_BITS), need]
        filters = numbered.mapInArrow(_shards(n, bits, rounds[0], bitmap), _FILTER)
        level = stage(_frequent(filters, n, bits, rounds, min_count), f"phrases-{n}")
        levels.append(level.select("lang", "ids", "f"))
        if n < max_words:
            bitmap = _bitmap(level)
            if bitmap is None:
                break
    release(numbered)
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return phrases, words.select("id", "word"), totals



def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, cover: int = COVER, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language by their lowest-scoring cut:
    (lang, rank, phrase, a, l, r, n, score, cut). A phrase inside a longer
    frequent one with at least ``cover`` percent of its count is dropped."""
    phrases, words, totals = frequent_phrases(docs, min_count, max_words)
    found = phrases.where(F.size("ids") > 1).withColumnRenamed("f", "a")
    size = F.size("ids")
    cuts = found.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("slice(ids, 1, k)").alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"))
    parts = small(phrases)
    cuts = cuts.join(parts.select("lang", F.col("ids").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("ids").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(small(totals), "lang")
    score = F.expr("1000BD * cast(a as decimal(38,0)) * cast(n as decimal(38,0)) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = (found.where(size > 2).select("lang", F.col("a").alias("longer"), F.explode(F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))")).alias("ids"))
        .groupBy("lang", "ids").agg(F.max("longer").alias("longer")))
    kept = scored.join(inside, ["lang", "ids"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    kept = kept.select("lang", "ids", "a", "n", "best.*")
    # ties stay until the words are known
    near = kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= top)
    spelled = (near.select("lang", "ids", F.posexplode("ids").alias("i", "id")).join(small(words), "id").groupBy("lang", "ids")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (near.join(spelled, ["lang", "ids"]).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("cut")))


def report(found: DataFrame) -> DataFrame:
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
