"""Suffix-array dedup of byte strings.

A byte is removed if a ``LENGTH``-byte string that covers it also starts
earlier in the corpus, by (doc_id, position). Suffixes of every position
would be many times the corpus, so the array is sparse: it holds the suffixes
that start at minimizers, the ``GRAM``-byte strings of least hash among those
inside some ``LENGTH``-byte window (all of equals). Every window holds one,
at the same offset wherever the window occurs, so no repeat is lost.

1. Texts that are equal as a whole are found by digest; the later ones go.
2. Minimizers (hash, document, position) that occur once are dropped.
   What repeats within a task is told apart there, so none is a hot key.
3. Each suffix left takes the bytes of all windows around its minimizer.
   Splitters sampled by Spark deal suffixes to ranges of (leading bytes,
   document, position), so a string that fills the corpus takes several
   buckets.
4. A bucket sorts its suffixes by multikey quicksort on eight-byte
   characters, and marks windows that a suffix with the same leading bytes
   has earlier. The first of each window in the leading bytes that a bucket
   shares with its neighbours are compared across buckets.
5. The marked windows of a document, merged, are cut out.

Cases: null texts count as empty; rows without a doc_id can't be named and
give none; rows that share a doc_id count once, with the text of smallest
digest; texts shorter than ``LENGTH`` bytes stay; an empty table gives none;
other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, small, stage, whole_texts
from .shingles import _powers, mix, slices, utf8

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM  # bytes of a window on either side of its minimizer
#: Repeated minimizers that a task remembers; beyond, it tells of them again.
TOLD_GRAMS = 1_000_000
#: Suffixes of a bucket, on average; a bucket is sorted in one piece.
BUCKET_ROWS = 200_000
GROUP_ROWS = 20_000

_U = np.uint64
_VALUES = mix((np.arange(256).astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = pick(out[:-have], out[have:]), have * 2
    return pick(out[:len(values) - width + 1], out[width - have:width - have + len(values) - width + 1]) if have < width else out


def minimizers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the minimizers of one text's bytes."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    up, down = _powers(1 << max(20, len(data).bit_length()))
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_VALUES[data] * up[:len(data)], dtype=_U, out=total[1:])
    h = mix((total[GRAM:] - total[:-GRAM]) * down[:len(data) - GRAM + 1])
    least = _sliding(h, SPAN + 1, np.minimum)
    top = np.zeros(SPAN, _U)
    reach = _sliding(np.concatenate([top, least, top]), SPAN + 1, np.maximum)  # largest minimum of the windows around
    at = np.flatnonzero(reach == h)
    return at, h[at]


def _firsts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that play a part (doc_id, text), and every document (doc_id,
    n_bytes, copy of an earlier one?)."""
    rows = whole_texts(docs).where(F.col("doc_id").isNotNull())
    digests = stage(rows.select("doc_id", F.unhex(F.sha1(F.col("text").cast("binary"))).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "suffix-digests")
    own = digests.groupBy("doc_id").agg(F.min(F.struct("digest", "n_bytes")).alias("d")).select("doc_id", "d.*")
    marked = stage(own.join(own.groupBy("digest").agg(F.min("doc_id").alias("first")), "digest").select("doc_id", "digest", "n_bytes", (F.col("first") != F.col("doc_id")).alias("copy")), "suffix-documents")
    others = marked.where("copy").select("doc_id")
    # rows whose text isn't the one that counts for their doc_id
    wrong = stage(digests.join(marked, ["doc_id", "digest"], "left_anti").select("doc_id", "digest"), "suffix-wrong")
    release(digests)
    texts = rows.join(small(stage(others, "suffix-copies")), "doc_id", "left_anti")
    texts = texts.join(small(wrong), (texts["doc_id"] == wrong["doc_id"]) & (F.unhex(F.sha1(texts["text"].cast("binary"))) == wrong["digest"]), "left_anti")
    return texts, marked.select("doc_id", "n_bytes", "copy")


def _split_repeats(grams: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``grams`` are known to repeat, being several here or in the
    sorted ``told``; and the several that aren't in ``told`` yet, sorted."""
    values, first, times = np.unique(grams, return_inverse=True, return_counts=True)
    old = np.isin(values, told, assume_unique=True)
    return ((times > 1) | old)[first], values[(times > 1) & ~old]


def _repeated_minimizers(texts: DataFrame) -> DataFrame:
    """(doc_id, pos) of minimizers whose bytes occur more than once.

    What repeats within a slice of a task is known at once: those rows go
    each by a key of its own, and one row without a document tells the other
    tasks. So of a string that is everywhere a window holds a few rows a
    task, not all of its places."""

    def tasks(batches):
        told = np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for a, b in slices(batch.column("text")):
                data, at = utf8(batch.column("text").slice(a, b - a))
                found = [minimizers(data[at[r]:at[r + 1]]) for r in range(b - a)]
                grams = np.concatenate([h for _, h in found]).view(np.int64)
                places = np.concatenate([pos for pos, _ in found])
                docs = np.repeat(ids[a:b], [len(pos) for pos, _ in found])
                known, news = _split_repeats(grams, told)
                if len(told) + len(news) <= TOLD_GRAMS:
                    told = np.union1d(told, news)
                own = docs * np.int64(1_000_003) + places
                none = np.ones(len(news), bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([grams, news])), pa.array(np.concatenate([own, np.zeros(len(news), np.int64)]), mask=np.concatenate([~known, none])),
                    pa.array(np.concatenate([docs, np.zeros(len(news), np.int64)]), mask=np.concatenate([np.zeros(len(docs), bool), none])),
                    pa.array(np.concatenate([places, np.zeros(len(news), np.int64)]).astype(np.int32))], ["gram", "own", "doc_id", "pos"])

    every = texts.mapInArrow(tasks, "gram long, own long, doc_id long, pos int")
    counted = every.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("gram", "own")))  # spills
    return counted.where(F.col("doc_id").isNotNull() & (F.col("own").isNotNull() | (F.col("times") > 1))).select("doc_id", "pos")


_SUFFIX = "lead binary, doc_id long, pos int, before int, bytes binary"


def _suffixes(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Each repeated minimizer (lead) with the bytes of the windows around it."""

    def tasks(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                text, doc = batch.column("text")[r].as_buffer().to_pybytes(), batch.column("doc_id")[r].as_py()
                at = np.unique(batch.column("at")[r].values.to_numpy())
                left = np.minimum(at, SPAN)
                yield pa.RecordBatch.from_arrays([
                    pa.array([text[p:p + GRAM] for p in at.tolist()], pa.binary()), pa.array(np.full(len(at), doc)), pa.array(at.astype(np.int32)), pa.array(left.astype(np.int32)),
                    pa.array([text[p - n:p + LENGTH] for p, n in zip(at.tolist(), left.tolist(), strict=True)], pa.binary())], ["lead", "doc_id", "pos", "before", "bytes"])

    return texts.join(places, "doc_id").select("doc_id", "text", "at").mapInArrow(tasks, _SUFFIX)


def multikey_order(keys: np.ndarray) -> np.ndarray:
    """Order of rows of unsigned integers, sorted character by character
    within the groups that are equal so far."""
    order, group = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    for column in keys.T:
        inner = np.lexsort((column[order], group))
        order = order[inner]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (column[order[1:]] != column[order[:-1]]) | (group[inner][1:] != group[inner][:-1])
        group = np.cumsum(fresh)
        if fresh.all():
            break
    return order


_MARK = "doc_id long, start int, end int, gram binary, offset int, window long"


def _window_marks(suffixes: DataFrame) -> DataFrame:
    """Rows of two kinds: windows that occur earlier in their bucket, merged
    into spans (``gram`` is null); and, for leading bytes at either end of a
    bucket, the bucket's first occurrence of each window."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("gram", pa.binary()), ("offset", pa.int32()), ("window", pa.int64())])

    def tasks(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        bucket = pa.Table.from_batches(parts).combine_chunks()
        lead = np.frombuffer(b"".join(bucket["lead"].to_pylist()), ">u8").reshape(-1, GRAM // 8)
        doc, pos, before = (bucket[c].to_numpy() for c in ("doc_id", "pos", "before"))
        places = np.column_stack([doc.astype(np.int64).view(_U) ^ _U(1 << 63), pos.astype(_U)])
        keys = np.column_stack([lead.astype(_U), places])
        order = multikey_order(keys)
        order = order[np.concatenate([[True], (keys[order[1:]] != keys[order[:-1]]).any(1)])]  # a repeated row's suffixes count once
        lead, doc, pos, before, texts = lead[order], doc[order], pos[order], before[order], bucket["bytes"].chunk(0).take(pa.array(order))
        group = np.cumsum(np.concatenate([[True], (lead[1:] != lead[:-1]).any(1)])) - 1
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        cuts, last = [0], 0
        for s in [*starts[1:].tolist(), len(group)]:  # whole groups, about GROUP_ROWS rows
            if s - last >= GROUP_ROWS or s == len(group):
                cuts.append(s)
                last = s
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield from _marks(group[a:b], lead[a:b], doc[a:b], pos[a:b], before[a:b], texts.slice(a, b - a), (0, group[-1]), schema)

    return suffixes.mapInArrow(tasks, _MARK)


def _marks(group, lead, doc, pos, before, texts, ends, schema):
    m, wide = len(group), SPAN + LENGTH
    sizes = np.array([len(x) for x in texts.to_pylist()], np.int64)
    board = np.zeros((m, wide), np.uint8)
    flat = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    row = np.repeat(np.arange(m), sizes)
    board[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(SPAN - before, sizes)] = flat
    up, down = _powers(1 << 20)
    total = np.zeros((m, wide + 1), _U)
    np.cumsum(_VALUES[board] * up[:wide], axis=1, dtype=_U, out=total[:, 1:])
    marked = np.zeros((m, SPAN + 1), bool)
    at_end = (group == ends[0]) | (group == ends[1])
    for j in range(SPAN + 1):  # the window that starts SPAN - j bytes before the minimizer
        inside = np.flatnonzero((SPAN - j <= before) & (sizes - before + SPAN >= j + LENGTH))
        if not len(inside):
            continue
        h = mix((total[inside, j + LENGTH] - total[inside, j]) * down[j])
        order = np.lexsort((h, group[inside]))  # stable: by place within equals
        rows, h = inside[order], h[order]
        again = np.zeros(len(rows), bool)
        again[1:] = (group[rows[1:]] == group[rows[:-1]]) & (h[1:] == h[:-1])
        marked[rows[again], j] = True
        keep = np.flatnonzero(~again & at_end[rows])
        if len(keep):
            r = rows[keep]
            start = (pos[r] - SPAN + j).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array(start), pa.array(start + np.int32(LENGTH)), pa.array([x.astype(">u8").tobytes() for x in lead[r]], pa.binary()),
                                              pa.array(np.full(len(r), j, np.int32)), pa.array(h[keep].view(np.int64))], schema=schema)
    edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    r, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    n = len(r)
    yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array((pos[r] - SPAN + first).astype(np.int32)), pa.array((pos[r] - SPAN + last + LENGTH).astype(np.int32)),
                                      pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], schema=schema)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, start, end) of repeats in ``texts`` (doc_id, text), which may overlap."""
    places = stage(_repeated_minimizers(texts), "suffix-places")
    per_doc = places.groupBy("doc_id").agg(F.collect_list("pos").alias("at"))
    suffixes = stage(_suffixes(texts, per_doc), "suffixes")
    release(places)
    n = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // BUCKET_ROWS))
    marks = stage(_window_marks(suffixes.repartitionByRange(n, "lead", "doc_id", "pos")), "suffix-marks")
    release(suffixes)
    across = marks.where("gram is not null")
    place = F.struct("doc_id", "start")
    earliest = Window.partitionBy("gram", "offset", "window")
    later = across.withColumn("first", F.min(place).over(earliest)).where(place != F.col("first"))
    spans = stage(marks.where("gram is null").select("doc_id", "start", "end").unionByName(later.select("doc_id", "start", "end")), "suffix-spans")
    release(marks)
    return spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the merged spans removed from each
    document, as (start, end), and the bytes that stay."""
    texts, every = _firsts(docs)
    per_doc = repeated_spans(texts).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = texts.join(per_doc, "doc_id", "left").select("doc_id", "text", "spans")
    kind = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def tasks(batches):
        for batch in batches:
            rows = []
            for doc, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                data, merged, kept, at = text.as_buffer().to_pybytes() if text.is_valid and len(text.as_py()) else b"", [], [], 0
                for s in sorted(spans or [], key=lambda s: (s["start"], s["end"])):
                    if merged and s["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                    else:
                        merged.append(dict(s))
                for s in merged:
                    kept.append(data[at:s["start"]])
                    at = s["end"]
                rows.append({"doc_id": doc, "n_bytes": len(data), "removed": merged, "kept": b"".join([*kept, data[at:]])})
            yield pa.RecordBatch.from_pylist(rows, out)

    cut = joined.mapInArrow(tasks, kind)
    copies = every.where(F.col("copy"))
    long_copy = F.col("n_bytes") >= LENGTH
    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    short = copies.where(~long_copy).select("doc_id").withColumnRenamed("doc_id", "short_id")
    whole = whole_texts(docs).join(small(stage(short, "suffix-short")), F.col("doc_id") == F.col("short_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
    gone = copies.where(long_copy).select("doc_id", "n_bytes", span.alias("removed"), F.lit(b"").alias("kept"))
    kept = whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast("array<struct<start:long,end:long>>").alias("removed"), F.col("text").cast("binary").alias("kept"))
    return cut.unionByName(gone).unionByName(kept)


def report(cut: DataFrame) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")).dropDuplicates(["doc_id"])
