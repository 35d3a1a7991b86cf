"""N-gram Jaccard join over a count-vector R-tree.

A document's set is its distinct five-word shingles. Shingles are hashed
into ``GROUPS`` groups, and the counts of a document's shingles by group are
its point. The overlap of two documents is at most the sum of the smaller
coordinates of their points, and for two boxes of points at most that of
their upper corners: an R-tree over the points drops whole boxes of pairs
that can't reach the similarity. Pairs that survive, and share as many of
their first shingles as similar sets must, are verified on the exact sets of
64-bit shingle hashes, made anew from the texts: a text compresses, hashes don't.

An R-tree over all documents would have to compare most boxes of documents
of similar length, so documents meet only where they share a shingle among
the first ``n - need + 1`` of a common order (rare shingles first, by
counters over all documents); two documents that are similar enough always
do. Equal sets are one class from the start. Classes that share a shingle
are first verified with the smallest class of that shingle, then twice with
one more class, another for each shingle, if no link joins them yet, and the links
found give components; only groups in which several components remain get
an R-tree, which is asked for pairs across components. So a group of near
copies costs about its size, and no link between components is lost. Groups
of many classes are dealt to pairs of blocks.

Cases: null or empty texts have an empty set and are linked with nothing;
rows without a doc_id can't be named and give none; rows that share a doc_id
are one document if their texts are equal, else linked; an empty table gives
none; other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, small, stage, whole_texts
from .components import components
from .shingles import shingle_hashes, slices

SHINGLE = 5
NEED = 75  # percent
GROUPS = 128
COUNTERS = 1 << 18
CHUNKS = 64
LEAF = 16
BLOCK = 2048
SALTS = 4
KEPT_PAIRS = 1_000_000
#: Bytes of text hashed at once.
SLICE_BYTES = 1 << 19
#: Times that classes are compared with one more of their shingles' classes before the R-tree is asked.
TURNS = 2
#: Pairs of one class that a group of ``_links`` compares.
HOME = 64

_SETS = "doc_id long, n long, class long, point binary, chunk int, counts binary"


def _class_of(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _per_text(batch: pa.RecordBatch):
    """(row in the batch, hashes) of each text."""
    texts = batch.column("text")
    for a, b in slices(texts, SLICE_BYTES):
        hashes, at = shingle_hashes(texts.slice(a, b - a), SHINGLE)
        for r in range(b - a):
            yield a + r, hashes[at[r]:at[r + 1]]


def _point_bytes(counts: np.ndarray) -> bytes:
    """Counts by group in 1, 2 or 4 bytes each, as the largest needs."""
    top = int(counts.max())
    return counts.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<i4").tobytes()


def _points(column) -> np.ndarray:
    """The points of a column as a matrix; a point's length tells its form."""
    raw = column.to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // GROUPS
    out = np.zeros((len(raw), GROUPS), np.int32)
    for size, kind in ((1, "u1"), (2, "<u2"), (4, "<i4")):
        rows = np.flatnonzero(sizes == size)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(raw if len(rows) == len(raw) else [raw[r] for r in rows]), kind).reshape(-1, GROUPS)
    return out


def sets_and_counters(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: for each document its set's size, class and point;
    for each task and chunk of counters the counts (``chunk`` is not null)."""

    def tasks(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("point", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())])
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            rows, seen = [], []
            for r, hashes in _per_text(batch):
                point = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS)
                rows.append({"doc_id": batch.column("doc_id")[r].as_py(), "n": len(hashes), "class": _class_of(hashes), "point": _point_bytes(point)})
                seen.append((hashes & np.uint64(COUNTERS - 1)).astype(np.int64))
            counters += np.bincount(np.concatenate(seen), minlength=COUNTERS) if seen else 0
            yield pa.RecordBatch.from_pylist(rows, schema)
        if counters.any():
            yield pa.RecordBatch.from_pylist([{"chunk": k, "counts": part.tobytes()} for k, part in enumerate(np.split(counters, CHUNKS))], schema)

    return whole_texts(docs).where(F.col("doc_id").isNotNull()).mapInArrow(tasks, _SETS)


def shingle_levels(parts: DataFrame) -> np.ndarray:
    """log2 level of each counter, summed over tasks; a fixed number of them
    comes to the driver."""

    def tasks(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(part.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    summed = parts.where("chunk is not null").select("chunk", "counts").repartition(CHUNKS, "chunk").mapInArrow(tasks, "chunk int, counts binary")
    total = np.zeros((CHUNKS, COUNTERS // CHUNKS), np.int64)
    for r in summed.collect():
        total[r.chunk] += np.frombuffer(r.counts, np.int64)
    return (2 * np.log2(total.ravel() + 1)).astype(np.uint8)


def _prefix_rows(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(token, class) of the first shingles of each set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # COUNTERS bytes

    def tasks(batches):
        for batch in batches:
            tokens, classes = [], []
            for r, hashes in _per_text(batch):
                if len(hashes):
                    n = len(hashes) - -(-NEED * len(hashes) // 100) + 1
                    order = np.argsort(shared.value[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")[:n]  # hashes are in order
                    tokens.append(hashes[order].view(np.int64))
                    classes.append(np.full(n, _class_of(hashes)))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, classes)], ["token", "class"])

    return docs.mapInArrow(tasks, "token long, class long")


def _enough(nx, ny, overlap) -> np.ndarray:
    return 100 * overlap >= NEED * (nx + ny - overlap)


def _least_shared(nx: Column, ny: Column) -> Column:
    """Of their first shingles, as ``_prefix_rows`` gives them, two similar
    sets share so many at least. At most ``nx - overlap`` shingles of x are
    not in y. Take as x the set whose first ones end earlier in the common
    order: those of them that are in y are among y's first ones too."""
    overlap = F.ceil((nx + ny) * NEED / (100 + NEED) - 1e-9)
    return overlap + 1 - F.ceil(F.greatest(nx, ny) * NEED / 100 - 1e-9)


class CountTree:
    """R-tree over points, packed in the order given: each level holds the
    upper corner and the smallest set size of ``LEAF`` nodes of the level below."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.levels = [(points, sizes)]
        while len(self.levels[-1][1]) > 1:
            p, n = self.levels[-1]
            at = np.arange(0, len(n), LEAF)
            self.levels.append((np.maximum.reduceat(p, at), np.minimum.reduceat(n, at)))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs x < y of points whose bound allows the similarity."""
        x = y = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            p, n = self.levels[depth]
            parts = [(a, b) for a, b in ((x[s:s + 20_000], y[s:s + 20_000]) for s in range(0, len(x), 20_000))]
            keep = [_enough(n[a], n[b], np.minimum(p[a], p[b]).sum(1)) & ((a < b) if depth == 0 else (a <= b)) for a, b in parts]
            keep = np.concatenate(keep) if keep else np.zeros(0, bool)
            x, y = x[keep], y[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                i, j = (k.ravel() for k in np.meshgrid(np.arange(LEAF), np.arange(LEAF), indexing="ij"))
                x, y = (x[:, None] * LEAF + i).ravel(), (y[:, None] * LEAF + j).ravel()
                inside = (x < below) & (y < below) & (x <= y)
                x, y = x[inside], y[inside]
        return x, y


def _tree_pairs(members: DataFrame) -> DataFrame:
    """(a, b, shared) of classes of one group (``token``, ``block``) and different
    components, that the R-tree can't rule out; ``shared`` counts a task's
    groups with the pair. ``members`` has ``side``: 0
    for blocks paired with themselves, else 1 or 2, and pairs are across."""

    def of(part: pa.Table, cuts: np.ndarray) -> np.ndarray:
        """Pairs of the groups of rows between ``cuts``. A group that fits in
        one leaf has no boxes above its points, so all leaves go together."""
        points = _points(part["point"])
        c, comp, n, side = (part[k].to_numpy() for k in ("class", "component", "n", "side"))

        def may_link(x, y):
            return (comp[x] != comp[y]) & ((side[x] == 0) | (side[x] != side[y]))

        found = [np.zeros((0, 2), np.int64)]
        sizes = np.diff(cuts)
        for size in np.unique(sizes[(sizes > 1) & (sizes <= LEAF)]):
            i, j = np.triu_indices(size, 1)
            starts = cuts[:-1][sizes == size][:, None]
            x, y = (starts + i).ravel(), (starts + j).ravel()
            ok = may_link(x, y) & _enough(n[x], n[y], np.minimum(n[x], n[y]))
            x, y = x[ok], y[ok]
            for s in range(0, len(x), 20_000):
                v, w = x[s:s + 20_000], y[s:s + 20_000]
                ok = _enough(n[v], n[w], np.minimum(points[v], points[w]).sum(1))
                found.append(np.column_stack([c[v[ok]], c[w[ok]]]))
        for first, size in zip(cuts[:-1][sizes > LEAF], sizes[sizes > LEAF], strict=True):
            order = first + np.lexsort((n[first:first + size], comp[first:first + size]))
            x, y = CountTree(points[order], n[order]).pairs()
            x, y = order[x], order[y]
            ok = may_link(x, y)
            found.append(np.column_stack([c[x[ok]], c[y[ok]]]))
        return np.sort(np.concatenate(found), axis=1)

    def tasks(batches):
        counted, fresh, waiting, held = np.zeros((0, 3), np.int64), [], 0, None

        def merged():
            pairs = np.concatenate([counted[:, :2], *fresh])
            times = np.concatenate([counted[:, 2], np.ones(len(pairs) - len(counted), np.int64)])
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs, times = pairs[order], times[order]
            at = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])[:len(pairs)])
            return np.column_stack([pairs[at], np.add.reduceat(times, at)]) if len(at) else counted

        def add(more, flush=False):
            nonlocal counted, fresh, waiting
            fresh.append(more)
            waiting += len(more)
            if flush or waiting > KEPT_PAIRS // 2:
                counted, fresh, waiting = merged(), [], 0
            if flush or len(counted) > KEPT_PAIRS // 2:
                out, counted = pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(k)) for k in counted.T], ["a", "b", "shared"]), counted[:0]
                return [out]
            return []

        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            k = np.stack([part["token"].to_numpy(), part["block"].to_numpy()])
            cuts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1])
            held = part.slice(cuts[-1])  # its group may go on
            if cuts[-1]:
                yield from add(of(part.slice(0, cuts[-1]), cuts))
        yield from add(of(held, np.array([0, len(held)])) if held is not None else counted[:0, :2], flush=True)

    ordered = members.repartition("family", F.pmod("token", F.lit(SALTS)), "block").sortWithinPartitions("token", "block", "class")
    return ordered.mapInArrow(tasks, "a long, b long, shared long")


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough, verified on the
    exact sets. Where ``pairs`` has ``shared``, the number of first shingles
    that the two have in common, those with too few aren't looked at."""
    x = classes.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    y = classes.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))

    def bound(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            p, q = _points(batch.column("pa")), _points(batch.column("pb"))
            ok = np.flatnonzero(_enough(na, nb, np.minimum(p, q).sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    size = classes.select("class", "n")
    sized = pairs.join(size.withColumnsRenamed({"class": "a", "n": "na"}), "a").join(size.withColumnsRenamed({"class": "b", "n": "nb"}), "b")
    sized = sized.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * NEED)
    if "shared" in pairs.columns:
        sized = sized.where(F.col("shared") >= _least_shared(F.col("na"), F.col("nb")))
    sized = stage(sized.select("a", "b"), "jaccard-sized")
    close = stage(sized.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(bound, "a long, b long"), "jaccard-close")
    release(sized)

    # each pair is compared where its a is, in one of a's parts
    parts = close.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HOME).alias("parts"))
    homes = close.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.col("b").alias("class"))
    needed = homes.unionByName(homes.select("a", "part", F.col("a").alias("class"))).distinct()
    needed = stage(needed.join(classes.select("class", "rep"), "class"), "jaccard-needed")

    def verify(batches):
        home, mine = None, None
        for batch in batches:
            a, part, own = (batch.column(c).to_numpy() for c in ("a", "part", "class"))
            found = []
            for r, hashes in _per_text(batch):
                if _class_of(hashes) != own[r]:
                    continue  # another text of the same doc_id
                if own[r] == a[r]:
                    home, mine = (a[r], part[r]), hashes.copy()
                elif home == (a[r], part[r]):
                    both = np.concatenate([mine, hashes])
                    both.sort()
                    if _enough(len(mine), len(hashes), int((both[1:] == both[:-1]).sum())):
                        found.append(r)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(found, pa.int64())) for c in ("a", "class")], ["a", "b"])

    texts = whole_texts(docs).join(small(needed), F.col("doc_id") == F.col("rep")).select("a", "part", "class", "text")
    texts = texts.repartition("a", "part").sortWithinPartitions("a", "part", F.col("class") != F.col("a"))
    links = stage(texts.mapInArrow(verify, "a long, b long").distinct(), "jaccard-links")
    release(close)
    release(needed)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    both = stage(sets_and_counters(docs), "jaccard-sets-counters")
    every = both.where("chunk is null").select("doc_id", "n", "class", "point")
    levels = shingle_levels(both)
    # the first aggregate keeps one row of a class for each task
    classes = stage(every.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point")), "jaccard-classes")
    copies = stage(every.join(classes.select(F.col("rep").alias("doc_id"), F.col("class").alias("own")), "doc_id", "left_anti").select("doc_id"), "jaccard-copies")
    firsts = whole_texts(docs).where(F.col("doc_id").isNotNull()).join(small(copies), "doc_id", "left_anti")
    group = Window.partitionBy("token")  # spills, so a hot shingle's rows needn't fit in memory
    entries = _prefix_rows(firsts, levels).withColumn("lead", F.min("class").over(group)).withColumn("last", F.max("class").over(group))
    entries = stage(entries.where("lead != last").select("token", "class", "lead").distinct(), "jaccard-entries")

    star = entries.where("class != lead").select(F.col("lead").alias("a"), F.col("class").alias("b")).distinct()
    links = _links(docs, classes, star)

    def labelled_by(links: DataFrame) -> DataFrame:
        labelled = entries.join(components(links).withColumnRenamed("id", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        return stage(labelled.select("token", "class", "component"), "jaccard-labelled")

    labelled = labelled_by(links)
    for turn in range(TURNS):
        # another class of each group beyond a leaf, a different one for each shingle, and the classes not yet in its component
        leads = labelled.groupBy("token").agg(F.min(F.struct(F.xxhash64("token", "class", F.lit(turn)).alias("order"), F.col("class").alias("lead"), F.col("component").alias("its"))).alias("l"),
                                              F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("size"))
        leads = leads.where("c0 != c1").where(F.col("size") > LEAF).select("token", "l.lead", "l.its")
        across = labelled.join(leads, "token").where("component != its").select(F.greatest("class", "lead").alias("a"), F.least("class", "lead").alias("b")).distinct()
        across = stage(across, "jaccard-across")
        links = links.unionByName(_links(docs, classes, across))
        release(across)
        release(labelled)
        labelled = labelled_by(links)
    release(entries)
    # groups with several components
    groups = (labelled.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 != c1"))
    groups = stage(groups.select("token", F.col("c0").alias("family"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "jaccard-groups")
    members = labelled.join(groups, "token").withColumn("mine", F.pmod(F.hash("class"), F.col("blocks")))
    # block pair (i, j), i <= j, as one number; a class goes to each pair with its block
    members = members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "with"), F.greatest("mine", "with")
    members = members.select("token", "family", (low.cast("long") * F.col("blocks") + high).alias("block"), F.when(F.col("mine") == F.col("with"), 0).when(F.col("mine") < F.col("with"), 1).otherwise(2).alias("side"),
                             "class", "component")
    points = classes.select("class", F.col("n"), "point")
    more = stage(_tree_pairs(members.join(points, "class")).groupBy("a", "b").agg(F.sum("shared").alias("shared")), "jaccard-pairs")
    release(labelled)
    links = links.unionByName(_links(docs, classes, more))

    reps = classes.select("class", "rep")
    by_rep = (links.join(reps.withColumnsRenamed({"class": "a", "rep": "ra"}), "a").join(reps.withColumnsRenamed({"class": "b", "rep": "rb"}), "b")
              .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    same = every.where("n > 0").join(reps, "class").select("doc_id", "n", "rep")
    found = components(by_rep.where("a != b")).withColumnsRenamed({"id": "rep", "component": "found"})
    placed = same.join(found, "rep", "left").select("doc_id", "n", F.coalesce("found", "rep").alias("component_id"))
    empty = every.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return placed.unionByName(empty).groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("component_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for the later documents of each component."""
    found = stage(near_duplicates(docs).where("doc_id != component_id").select(F.col("doc_id").alias("later_id")), "jaccard-later")
    return docs.join(small(found), F.col("doc_id") == F.col("later_id"), "left_anti")
