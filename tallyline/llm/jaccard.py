"""Exact n-gram Jaccard join with a count-vector R-tree.

1. Texts with equal shingle sets form one class, read from the smallest ``doc_id`` that has it.
2. A class is posted under its first shingles in one fixed order; how many is set by the
   threshold, so that linked classes share one of them. Shingles that are frequent in some task
   come last in the order (any order is exact; this one keeps frequent passages out).
3. A class's shingles, hashed into groups, give a vector of counts. Classes that share a posting are
   joined by an R-tree over these vectors: the sum of coordinate minima bounds the overlap, of node
   corners as of points. Only a spanning forest of the pairs that pass is kept, so a group of
   ``k`` copies gives ``k - 1`` rows. Postings of many classes are cut into blocks, and
   tasks are blocks and pairs of blocks.
4. Components of these pairs are families. A family's whole sets meet in blocks of bounded size, pairs
   that pass the R-tree are verified unless a verified path joins them already, and
   components of the verified links are the result.

Defined cases: null or empty texts have no shingles and link with nothing; texts of fewer words than
a shingle are one shingle; rows of one ``doc_id`` are one vertex of the graph, with the links of all its
texts, and its count is that of its largest set; rows with a null ``doc_id`` are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_scope

from . import common
from .components import connected_components

#: Coordinates of the R-tree's points, and set sizes from which finer vectors decide (powers of two).
GROUPS = 64
FINER = ((1024, 256), (8192, 512))
#: Classes in one block of a posting; shingles in one block of a family.
BLOCK_CLASSES = 2048
BLOCK_SHINGLES = 1 << 21
#: A shingle is frequent in a task if it is in this share of its documents, and in four.
FREQUENT = 1 / 256
FANOUT = 16


def shingle_set(hashes: common.WordHashes, text: bytes | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = common.space_words(text)
    if len(words) >= size:
        return np.unique(common.windows(hashes.of(words), size))
    return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64) if words else np.empty(0, np.uint64)


def needed(a, b, percent: int):
    """The least overlap of linked sets of sizes ``a`` and ``b``."""
    return -(-percent * (a + b) // (100 + percent))


def _dims(n: int) -> int:
    return max([GROUPS, *(d for limit, d in FINER if n >= limit)])


def vector(s: np.ndarray) -> np.ndarray:
    d = _dims(len(s))
    return np.bincount((s & np.uint64(d - 1)).astype(np.int64), minlength=d)


def packed(v: np.ndarray) -> bytes:
    """Counts in as many bytes each as the largest takes."""
    return v.astype(np.min_scalar_type(int(v.max()))).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    """The vector of a set of ``n``, whose length tells a count's width."""
    return np.frombuffer(raw, f"u{len(raw) // _dims(n)}").astype(np.int64)


def _fold(v: np.ndarray, d: int) -> np.ndarray:
    return v.reshape(-1, d).sum(0)


class Tree:
    """A bulk-loaded R-tree: points sorted by size and first coordinates, ``FANOUT`` to a node."""

    def __init__(self, points: np.ndarray, n: np.ndarray) -> None:
        self.order = np.lexsort((points[:, 1], points[:, 0], n))
        self.top, self.low, self.high = [points[self.order]], [n[self.order]], [n[self.order]]
        while len(self.top[-1]) > 1:
            cuts = np.arange(0, len(self.top[-1]), FANOUT)
            self.top.append(np.maximum.reduceat(self.top[-1], cuts))
            self.low.append(np.minimum.reduceat(self.low[-1], cuts))
            self.high.append(np.maximum.reduceat(self.high[-1], cuts))

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of pairs of points (numbers in the input) whose bound reaches the threshold."""
        todo = [(len(self.top) - 1, np.array([0]), np.array([0]))]
        while todo:
            level, i, j = todo.pop()
            if len(i) > 1 << 14:
                half = len(i) // 2
                todo += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
                continue
            low = self.low[level]
            # sizes first: the smaller set holds `percent` of the larger at least
            keep = (100 * self.high[level][i] >= percent * low[j]) & (100 * self.high[level][j] >= percent * low[i])
            i, j = i[keep], j[keep]
            if level == 0:
                i, j = i[i < j], j[i < j]
            bound = np.minimum(self.top[level][i], self.top[level][j]).sum(1)
            keep = bound >= needed(low[i], low[j], percent)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if level == 0:
                yield self.order[i], self.order[j]
                continue
            size = len(self.top[level - 1])
            own = np.arange(FANOUT)
            a = (i[:, None, None] * FANOUT + own[None, :, None]).repeat(FANOUT, 2).ravel()
            b = (j[:, None, None] * FANOUT + own[None, None, :]).repeat(FANOUT, 1).ravel()
            inside = (a < size) & (b < size) & (a <= b)
            todo.append((level - 1, a[inside], b[inside]))


class Forest:
    """Union-find over numbers."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _fine(vectors: list[np.ndarray], x: int, y: int, n: np.ndarray, percent: int) -> bool:
    """The bound by the finer vectors of large sets."""
    d = min(len(vectors[x]), len(vectors[y]))
    return d <= GROUPS or np.minimum(_fold(vectors[x], d), _fold(vectors[y], d)).sum() >= needed(int(n[x]), int(n[y]), percent)


def spanning(vectors: list[np.ndarray], n: np.ndarray, percent: int, verify=None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass the bound, and ``verify(x, y)`` where given.

    With ``side`` only pairs from both sides count: each side's own pairs are another task's.
    """
    points = np.stack([_fold(v, GROUPS) for v in vectors]).astype(np.int64)
    forest, out = Forest(len(n)), []
    for i, j in Tree(points, n).pairs(percent):
        if side is not None:
            across = side[i] != side[j]
            i, j = i[across], j[across]
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            if forest.root(x) != forest.root(y) and _fine(vectors, x, y, n, percent) and (verify is None or verify(x, y)):
                forest.join(x, y)
                out.append((x, y))
    return out


def frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles that some task finds in a ``FREQUENT`` share of its documents, sorted.

    A document of ``m`` shingles adds at most ``m / FREQUENT`` over the table of them, whatever the
    number of documents; of these the ones that most tasks name are kept, up to a million.
    """

    def run(batches):
        hashes = common.WordHashes()
        n, parts, held = 0, [], 0
        kept, times = np.empty(0, np.uint64), np.empty(0, np.int64)

        def merge():
            nonlocal kept, times, parts, held
            new, count = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_counts=True)
            keys, inverse = np.unique(np.concatenate([kept, new]), return_inverse=True)
            total = np.bincount(inverse, np.concatenate([times, count]), len(keys)).astype(np.int64)
            often = total > n * FREQUENT / 2  # rarer ones start again
            kept, times, parts, held = keys[often], total[often], [], 0

        for batch in batches:
            for text in common.binary_list(batch.column(0)):
                s = shingle_set(hashes, text, size)
                n += 1
                parts.append(s)
                held += len(s)
                if held > 1 << 21:
                    merge()
        if n:
            merge()
            often = times >= max(4, n * FREQUENT)
            if often.any():
                yield pa.RecordBatch.from_arrays([pa.array(kept[often].view(np.int64)), pa.array(times[often])], names=["h", "n"])

    found = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "h").limit(1 << 20).select("h").toArrow()
    return np.sort(rows.column("h").to_numpy().view(np.uint64))


def _sets(docs: DataFrame, size: int, percent: int, last: np.ndarray) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(last)

    def task():
        hashes = common.WordHashes()
        rare_last = held.value

        def step(batch):
            out = {k: [] for k in ("n", "signature", "vector", "posted")}
            for text in common.binary_list(batch.column(1)):
                s = shingle_set(hashes, text, size)
                n = len(s)
                first = n - -(-percent * n // 100) + 1 if n else 0
                posted = s
                if len(rare_last) and n:
                    at = np.minimum(np.searchsorted(rare_last, s), len(rare_last) - 1)
                    hot = rare_last[at] == s
                    posted = np.concatenate([s[~hot], s[hot]])
                out["n"].append(n)
                out["signature"].append(xxhash.xxh3_128_digest(s.tobytes()))
                out["vector"].append(packed(vector(s)))
                out["posted"].append(posted[:first].view(np.int64))
            return {"doc_id": batch.column(0)} | out

        return step

    return common.map_batches(docs, task, "doc_id long, n long, signature binary, vector binary, posted array<long>")


def _met(rows: DataFrame, key: str, weight: str, limit: int, percent: int) -> DataFrame:
    """``rows(key, id, n, total, ...)`` dealt out to tasks ``(key, lo, hi)`` of bounded size.

    Up to ``limit`` of ``total`` weight, a key is one task. Beyond it is cut into blocks: by size, in bands whose
    width is the threshold's ratio, so that linked sets lie in one band or in neighbours, and within a band by
    a hash of ``id``. A block is a task, and so is each pair of blocks of one band or of neighbours,
    where ``side`` tells the two apart; every two sets that can be linked meet in exactly one task.
    """
    none = F.lit(0).cast("long")
    small = rows.where(F.col("total") <= limit).withColumns({"lo": none, "hi": none, "side": F.lit(False)})
    band = F.floor(F.log(F.col("n")) / float(np.log(100 / percent))).cast("long") if percent < 100 else F.col("n")
    big = rows.where(F.col("total") > limit).withColumn("band", band)
    bands = big.groupBy(key, "band").agg(F.ceil(F.sum(weight) / limit).cast("long").alias("salts"))
    bands = materialize(bands, "jaccard-bands")
    big = (
        big.join(bands, [key, "band"])
        .join(bands.select(key, (F.col("band") - 1).alias("band"), F.col("salts").alias("above")), [key, "band"], "left")
        .join(bands.select(key, (F.col("band") + 1).alias("band"), F.col("salts").alias("below")), [key, "band"], "left")
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    )
    block = lambda b, x: b * F.lit(1 << 32) + x
    own = block(F.col("band"), F.col("salt"))
    task = lambda lo, hi, side: F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(side).alias("side"))
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint,side:boolean>>")

    def tasks(first: Column, last: Column, band: Column, side: bool) -> Column:
        """One task with each of a band's blocks ``first`` to ``last``."""
        other = lambda x: task(block(band, x), own, True) if side else task(own, block(band, x), False)
        return F.when(last >= first, F.transform(F.sequence(first, last), other)).otherwise(empty)

    b, salt, zero = F.col("band"), F.col("salt"), F.lit(0).cast("long")
    every = F.concat(
        F.array(task(own, own, False)),
        tasks(salt + 1, F.col("salts") - 1, b, False),
        tasks(zero, salt - 1, b, True),
        tasks(zero, F.coalesce("above", zero) - 1, b + 1, False),
        tasks(zero, F.coalesce("below", zero) - 1, b - 1, True),
    )
    dealt = big.withColumn("task", F.explode(every)).select(*rows.columns, "task.lo", "task.hi", "task.side")
    return small.unionByName(dealt)


def _parts(table: pa.Table, key: str) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """A group's tasks: the numbers of their rows, and the sides where there are two."""
    k, lo, hi, ids = (table.column(c).to_numpy() for c in (key, "lo", "hi", "id"))
    side = table.column("side").to_numpy()
    order = np.lexsort((ids, hi, lo, k))
    k, lo, hi = k[order], lo[order], hi[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(k) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(k)], strict=True):
        at = order[a:b]
        if len(at) > 1:
            yield at, None if lo[a] == hi[a] else side[at]


def _pairs_table(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """A spanning forest of each posting's pairs that pass the bound."""
    postings = classes.select("id", "n", F.explode("posted").alias("h"))
    # counted before the shuffle, so a frequent shingle is no single task's; AQE splits its part of the join
    met = postings.groupBy("h").agg(F.count(F.lit(1)).alias("total")).where("total > 1")
    shared = postings.join(met, "h").select("id", "n", "h", "total")
    shared, seen = materialize(shared, "jaccard-postings", observe=[F.count(F.lit(1)).alias("n")])
    met = _met(shared.withColumn("one", F.lit(1)), "h", "one", BLOCK_CLASSES, percent)
    with_vector = met.select("id", "n", "h", "lo", "hi", "side").join(classes.select("id", "vector"), "id")
    groups = F.pmod(F.xxhash64("h", "lo", "hi"), F.lit(max(1, seen["n"] >> 14)))

    def run(table: pa.Table) -> pa.Table:
        ids, n = (table.column(c).to_numpy() for c in ("id", "n"))
        raw = table.column("vector").to_pylist()
        out: set[tuple[int, int]] = set()
        known: dict[tuple[int, int], bool] = {}
        for at, side in _parts(table, "h"):
            if len(at) == 2:  # most postings; the same pair often shares several
                x, y = at.tolist()
                key = (min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y])))
                if (side is None or side[0] != side[1]) and key not in known:
                    known[key] = passes(raw[x], raw[y], int(n[x]), int(n[y]), percent)
                if known.get(key):
                    out.add(key)
                continue
            vectors = [unpacked(raw[k], int(n[k])) for k in at.tolist()]
            for x, y in spanning(vectors, n[at], percent, side=side):
                a, b = int(ids[at[x]]), int(ids[at[y]])
                out.add((min(a, b), max(a, b)))
        return _pairs_table(sorted(out))

    return with_vector.withColumn("g", groups).groupBy("g").applyInArrow(run, "a long, b long").distinct()


def passes(x: bytes, y: bytes, a: int, b: int, percent: int) -> bool:
    """The bound for one pair, by the finest vectors both have."""
    if 100 * min(a, b) < percent * max(a, b):
        return False
    u, v = unpacked(x, a), unpacked(y, b)
    if len(u) != len(v):
        d = min(len(u), len(v))
        u, v = _fold(u, d), _fold(v, d)
    return int(np.minimum(u, v).sum()) >= needed(a, b, percent)


def _verified(docs: DataFrame, families: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """A spanning forest of the links between classes of one family."""

    def task():
        hashes = common.WordHashes()

        def step(batch):
            out = {k: [] for k in ("id", "family", "n", "total", "shingles")}
            others = [batch.column(i).to_pylist() for i in (0, 2, 3, 5)]
            for text, signature, *row in zip(common.binary_list(batch.column(1)), batch.column(4).to_pylist(), *others, strict=True):
                s = shingle_set(hashes, text, size).tobytes()
                if xxhash.xxh3_128_digest(s) == signature:  # of rows with one doc_id, the class's own
                    for k, v in zip(out, (*row, s), strict=True):
                        out[k].append(v)
            return out

        return step

    members = families.select("id", F.col("component").alias("family")).join(classes.select("id", "holder", "n", "signature"), "id")
    totals = members.groupBy("family").agg(F.sum("n").alias("total"))
    members, seen = materialize(members.join(totals, "family"), "jaccard-families", observe=[F.coalesce(F.sum("n"), F.lit(0)).alias("n")])
    # members grow with the corpus: one plan at all sizes, texts are dealt out by id
    wanted = members.select(F.col("holder").alias("doc_id"), "id", "family", "n", "signature", "total").hint("shuffle_merge")
    texts = docs.join(wanted, "doc_id")
    sets = common.map_batches(texts.select("id", "text", "family", "n", "signature", "total"), task, "id long, family long, n long, total long, shingles binary")
    sets = materialize(sets, "jaccard-sets")
    met = _met(sets, "family", "n", BLOCK_SHINGLES, percent)

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        raw = table.column("shingles").to_pylist()
        out = []
        for at, side in _parts(table, "family"):
            part = [np.frombuffer(raw[k], np.uint64) for k in at.tolist()]

            def linked(x: int, y: int, part=part) -> bool:
                p, q = part[x], part[y]
                both = len(np.intersect1d(p, q, assume_unique=True))
                return 100 * both >= percent * (len(p) + len(q) - both)

            n = np.array([len(s) for s in part], np.int64)
            out += [(int(ids[at[x]]), int(ids[at[y]])) for x, y in spanning([vector(s) for s in part], n, percent, linked, side)]
        return _pairs_table(out)

    # whole tasks to a group; small families share one
    groups = F.pmod(F.xxhash64("family", "lo", "hi"), F.lit(max(1, seen["n"] >> 20)))
    columns = met.select("id", "family", "shingles", "lo", "hi", "side")
    return columns.withColumn("g", groups).groupBy("g").applyInArrow(run, "a long, b long")


def join(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document of ``docs(doc_id, text)``: ``n_shingles`` and ``component_id``, the smallest ``doc_id``
    reachable by links of Jaccard similarity ``percent`` / 100 or more."""
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    with scratch_scope(spark):
        rows = materialize(_sets(docs, size, percent, frequent(docs, size)), "jaccard-rows")
        # a class is numbered; its texts are read from the smallest id that has it
        kinds = rows.where("n > 0").groupBy("n", "signature")
        kinds = kinds.agg(F.first("vector").alias("vector"), F.first("posted").alias("posted"), F.min("doc_id").alias("holder"))
        classes = materialize(kinds.withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
        member = rows.select("doc_id", "n", "signature").distinct().join(classes.select("n", "signature", "id"), ["n", "signature"], "left")
        member = materialize(member.select("doc_id", "n", "signature", "id"), "jaccard-members")
        families = connected_components(_candidates(classes, percent), "jaccard-candidates")
        links = _verified(docs, families, classes, size, percent)
        # rows of one id are one vertex: their classes are linked
        several = member.where("id is not null").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z")
        same = member.join(several, "doc_id").where("id > a").select("a", F.col("id").alias("b"))
        components = connected_components(links.unionByName(same), "jaccard-links")
        found = member.join(components, "id", "left").withColumn("key", F.coalesce("component", "id"))
        least = found.where("component is not null or id is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
        out = found.join(least, "key", "left").groupBy("doc_id").agg(
            F.max("n").alias("n_shingles"), F.coalesce(F.min("least"), F.col("doc_id")).alias("component_id")
        )
        return materialize(out, "jaccard-result", keep=True)
