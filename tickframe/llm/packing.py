"""Token ids in bit-packed files.

A token file is a Parquet folder whose rows are blocks in ascending document
order: each block holds whole documents, every id in the ``bits`` that the
vocabulary needs, packed without gaps, and the block's offsets (first id of
each document). numpy unpacks a block in one go; a document, or any id, is
reached by its block and offset alone. Parquet is the container so that
writing goes through Spark's commit protocol to any store: a task that is
lost and run again leaves no half-written file.

Documents are dealt to partitions by ranges of doc_id, so partition p holds
smaller ids than partition p + 1; a partition's blocks count ids from its
own start, and a second small table holds the start of each partition.

Cases: a null text counts as empty; rows with equal doc_id stay separate
rows, in the order of their texts' hashes; null doc_ids come first; an empty
table gives no rows; other columns play no part. A block holds ``block_ids``
ids or one longer document.
"""

from __future__ import annotations

import os
import uuid
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, whole_texts
from .words import gather, word_slices

BLOCK = "part int, block long, first_id long, n_ids long, bits int, doc_ids array<long>, offsets array<long>, payload binary"
BLOCK_IDS = 1 << 19
#: Distinct words whose ids a worker keeps.
KEPT_WORDS = 200_000


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits, each in ``bits`` bits, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    shifts = np.arange(bits, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> shifts & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from id number ``first`` of a packed block on."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    start = first * bits
    raw = np.frombuffer(payload, np.uint8)[start // 8:(start + count * bits + 7) // 8]
    flat = np.unpackbits(raw, bitorder="little")[start % 8:start % 8 + count * bits].reshape(count, bits)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    special = [x.content for x in t.get_added_tokens_decoder().values() if x.special]
    return t, special, {}


def vocabulary_bits(path: str) -> int:
    return max(1, int(_tokenizer(path)[0].get_vocab_size() - 1).bit_length())


@lru_cache(maxsize=1)
def _byte_signs(path: str) -> np.ndarray | None:
    """The character by which the vocabulary spells each byte, as the
    library's own byte-level step gives it; None where that step isn't all
    that happens to a word before the merges."""
    from tokenizers import pre_tokenizers

    tokenizer, _, _ = _tokenizer(path)
    step = tokenizer.pre_tokenizer
    if tokenizer.normalizer is not None or not isinstance(step, pre_tokenizers.ByteLevel) or step.add_prefix_space:
        return None
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    signs = np.zeros(256, "<u4")
    # every byte that UTF-8 uses: all characters of one and two bytes, one for each first byte of longer ones
    for code in [*range(0x801), *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)]:
        for byte, sign in zip(chr(code).encode(), spell.pre_tokenize_str(chr(code))[0][0], strict=True):
            signs[byte] = ord(sign)
    return signs


def _encoded(path: str, words: list[str]) -> list[bytes]:
    """Little-endian ids of each word by the library: its merges alone where
    the words are spelled here, 65,536 words at a time, else its whole chain."""
    tokenizer, _, _ = _tokenizer(path)
    signs = _byte_signs(path)
    if signs is None:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    model, out = tokenizer.model, []
    for first in range(0, len(words), 1 << 16):
        raw = [w.encode() for w in words[first:first + (1 << 16)]]
        ends = np.cumsum([len(x) for x in raw]).tolist()
        spelled = signs[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-32-le")
        coded = [[t.id for t in model.tokenize(spelled[a:b])] for a, b in zip([0, *ends], ends)]
        flat = np.array([i for ids in coded for i in ids], "<u4").tobytes()
        stops = (4 * np.cumsum([len(ids) for ids in coded])).tolist()
        out += [flat[a:b] for a, b in zip([0, *stops], stops)]
    return out


def _word_ids(path: str, words: list[str]) -> list[bytes]:
    """Ids of each distinct word of a slice. A bounded number is kept from
    slice to slice; when that is full, only words that this slice used again stay."""
    known = _tokenizer(path)[2]
    fresh = [w for w in words if w not in known]
    new = dict(zip(fresh, _encoded(path, fresh), strict=True))
    out = [new[w] if w in new else known[w] for w in words]
    if len(known) + len(new) > KEPT_WORDS:
        used = {w: known[w] for w in words if w in known}
        known.clear()
        known.update(used)
    known.update(islice(new.items(), max(KEPT_WORDS - len(known), 0)))
    return out


def write_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Encode every row's whole text with the tokenizers library, append
    ``end_id``, and write the token file to ``path``. The words that
    ``pattern`` splits are the tokenizer's own pre-tokens, so each distinct
    word of a slice is encoded once; a text that holds a special token's
    string is encoded whole."""
    bits = vocabulary_bits(tokenizer_path)

    def tasks(batches):
        tokenizer, special, _ = _tokenizer(tokenizer_path)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held, doc_ids, sizes, n_held = [], [], [], 0

        def flush():
            nonlocal block, start, held, doc_ids, sizes, n_held
            offsets = np.cumsum(sizes) - sizes
            row = pa.RecordBatch.from_pylist([{"part": part, "block": block, "first_id": start, "n_ids": n_held, "bits": bits, "doc_ids": doc_ids,
                                               "offsets": offsets.tolist(), "payload": pack(np.concatenate(held), bits)}], schema)
            block, start = block + 1, start + n_held
            held, doc_ids, sizes, n_held = [], [], [], 0
            return row

        schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])
        end = np.array([end_id], np.uint32)
        for batch in batches:
            names, words = batch.column("doc_id").to_pylist(), batch.column("words")
            for first, last, offsets, distinct, index in word_slices(words):
                texts = distinct.to_pylist()
                coded = _word_ids(tokenizer_path, texts)
                n = np.array([len(x) // 4 for x in coded], np.int64)
                ids = gather(np.frombuffer(b"".join(coded), "<u4"), np.cumsum(n) - n, n, index)
                own = np.concatenate([[0], np.cumsum(n[index])])[offsets]
                marked = [s for s in special if any(s[:2] in w for w in texts)]
                for r in range(last - first):
                    one = ids[own[r]:own[r + 1]]
                    if marked and any(s in (text := "".join(words[first + r].as_py())) for s in marked):
                        one = np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                    held += [one, end]
                    doc_ids.append(names[first + r])
                    sizes.append(len(one) + 1)
                    n_held += len(one) + 1
                    if n_held >= block_ids:
                        yield flush()
        if doc_ids:
            yield flush()

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = whole_texts(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    split = ranged.select("doc_id", F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0)).alias("words"))
    split.mapInArrow(tasks, BLOCK).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each partition of the write
    (totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")).write.parquet(f"{path}/parts"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``first_id`` counted over the whole file."""
    parts = spark.read.schema("part int, base long").parquet(f"{path}/parts")
    return (spark.read.schema(BLOCK).parquet(f"{path}/blocks").join(F.broadcast(parts), "part")
            .withColumn("first_id", F.col("first_id") + F.col("base")).drop("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document, unpacked from the
    file; ids as little-endian unsigned 32-bit integers."""

    def tasks(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = [*row["offsets"][1:], row["n_ids"]]
                ids = unpack(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
                offsets = np.array(row["offsets"], np.int64)
                n = np.array(ends, np.int64) - offsets
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(offsets + row["first_id"]), pa.array(n),
                     pa.array([ids[a:b].tobytes() for a, b in zip(offsets, ends, strict=True)], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return read_blocks(spark, path).mapInArrow(tasks, "doc_id long, start long, n_tokens long, ids binary")


def read_ids(spark: SparkSession, path: str, first: int, count: int) -> list[int]:
    """Random access: ids ``first .. first + count - 1`` of the file, from
    the blocks that hold them and no others; ``count`` is the caller's."""
    last = first + count
    rows = read_blocks(spark, path).where((F.col("first_id") < last) & (F.col("first_id") + F.col("n_ids") > first)).orderBy("first_id").collect()
    out: list[int] = []
    for r in rows:
        a, b = max(first, r.first_id) - r.first_id, min(last, r.first_id + r.n_ids) - r.first_id
        out += unpack(bytes(r.payload), r.bits, a, b - a).tolist()
    return out


def new_file(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"


def crc_of(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned CRC-32 of the ids' bytes."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
