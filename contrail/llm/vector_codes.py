"""Vector codes by Lloyd rounds over cover trees.

Vectors become integers and are cut into parts; each part position has a codebook.
A task lays the vectors of its partition out in blocks and builds a cover tree per
block and part over the distinct parts: a node has a centre and the greatest
distance to what is below it, children lie within half the radius of their parent
and apart from one another, and everything below a node is one range of the tree's
order, so that running sums give its count and sum. The trees are stored once. A
round compares centres with the codebook: where the nearest entry is nearer than
any other even for the farthest point below, the whole range is assigned and its
sums are read off the running sums; other nodes hand over to their children, and
small ambiguous nodes compare their points exactly. Equal parts are one weighted
point, so groups of copies cost one.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.scratch import store
from contrail.operators.keyed import lookup

BLOCK = 2048  # vectors of a block
FEW = 8  # points that a node compares one by one
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024


# ---- distances -----------------------------------------------------------------
def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, points by entries."""
    reach = max((int(np.abs(x).max()) for x in (points, entries) if x.size), default=0)
    if reach * reach * 4 * max(1, points.shape[1]) < 2**53:  # exact in doubles
        p, e = points.astype(np.float64), entries.astype(np.float64)
        d = (p * p).sum(1)[:, None] + (e * e).sum(1)[None, :] - 2 * (p @ e.T)
        return d.astype(np.int64)
    out = np.empty((len(points), len(entries)), dtype=np.int64)
    for j, e in enumerate(entries):
        out[:, j] = ((points - e) ** 2).sum(1)
    return out


# ---- the tree ------------------------------------------------------------------
class CoverTree:
    """Nodes (centre, radius, range, children) over distinct weighted points."""

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        self.points, self.weights = points, weights
        self.order = np.arange(len(points))
        self.centre, self.radius, self.lo, self.hi = [], [], [], []
        self.child_lo, self.child_hi = [], []
        if len(points):
            self._build()
        self._freeze()

    def _build(self) -> None:
        every = np.arange(len(self.points))
        level = [(0, every, self._from(0, every), 0)]
        while level:
            below = []
            for centre, members, distance, lo in level:
                radius = float(distance.max())
                at = len(self.centre)
                self.centre.append(centre)
                self.radius.append(radius)
                self.lo.append(lo)
                self.hi.append(lo + len(members))
                self.child_lo.append(0)
                self.child_hi.append(0)
                if len(members) <= FEW or radius == 0:
                    self.order[lo : lo + len(members)] = members
                    continue
                first = len(below)
                for child in self._children(centre, members, distance, radius):
                    below.append((*child, lo))
                    lo += len(child[1])
                self.child_lo[at], self.child_hi[at] = first, len(below)  # places in the next level
            start = len(self.centre)
            for at in range(start - len(level), start):
                if self.child_hi[at] > self.child_lo[at]:
                    self.child_lo[at] += start
                    self.child_hi[at] += start
            level = below

    def _from(self, centre: int, members: np.ndarray) -> np.ndarray:
        gap = (self.points[members] - self.points[centre]).astype(np.float64)
        return np.sqrt((gap * gap).sum(1))

    def _children(self, centre: int, members: np.ndarray, distance: np.ndarray, radius: float) -> Iterator[tuple]:
        """Centres more than half the radius apart, each with what is within that of it."""
        reach = radius / 2
        while len(members):
            near = distance <= reach
            yield centre, members[near], distance[near]
            members = members[~near]
            if len(members):
                centre = int(members[0])
                distance = self._from(centre, members)

    def _freeze(self) -> None:
        for name in ("centre", "lo", "hi", "child_lo", "child_hi"):
            setattr(self, name, np.array(getattr(self, name), dtype=np.int32))
        self.radius = np.array(self.radius, dtype=np.float64)

    def pack(self) -> dict[str, np.ndarray]:
        small = self.points.astype(np.int32)
        points = small if np.array_equal(small, self.points) else self.points
        kept = {n: getattr(self, n) for n in ("centre", "radius", "lo", "hi", "child_lo", "child_hi")}
        return kept | {"points": points, "weights": self.weights.astype(np.int32), "order": self.order.astype(np.int32)}

    @classmethod
    def unpack(cls, held: dict[str, np.ndarray]) -> CoverTree:
        tree = cls.__new__(cls)
        for name, values in held.items():
            setattr(tree, name, values)
        tree.points, tree.weights = tree.points.astype(np.int64), tree.weights.astype(np.int64)
        return tree

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(entry of each point, counts, sums, points compared one by one)."""
        k, w = entries.shape
        chosen = np.empty(len(self.points), dtype=np.int64)
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, w), dtype=np.int64)
        if not len(self.points):
            return chosen, counts, sums, 0
        ranked_weights = self.weights[self.order]
        weight_before = np.concatenate([[0], np.cumsum(ranked_weights)])
        sum_before = np.concatenate([np.zeros((1, w), np.int64), np.cumsum(self.points[self.order] * ranked_weights[:, None], axis=0)])
        front, doubtful = np.array([0]), []
        while len(front):
            d = squared(self.points[self.centre[front]], entries)
            best = d.argmin(1)  # the first of equal ones
            rows = np.arange(len(front))
            near = np.sqrt(d[rows, best].astype(np.float64))
            d[rows, best] = np.iinfo(np.int64).max
            other = np.sqrt(d.min(1).astype(np.float64))
            radius = self.radius[front]
            # A point: its distances to all entries were just compared. Else the margin covers rounding.
            sure = (radius == 0) | (near + 2 * radius + 1e-9 * (1 + other) < other)
            done = front[sure]
            lo, hi = self.lo[done], self.hi[done]
            np.add.at(counts, best[sure], weight_before[hi] - weight_before[lo])
            np.add.at(sums, best[sure], sum_before[hi] - sum_before[lo])
            for a, b, e in zip(lo.tolist(), hi.tolist(), best[sure].tolist(), strict=True):
                chosen[self.order[a:b]] = e
            rest = front[~sure]
            inner = self.child_hi[rest] > self.child_lo[rest]
            doubtful += [self.order[a:b] for a, b in zip(self.lo[rest[~inner]], self.hi[rest[~inner]], strict=True)]
            spans = [np.arange(a, b) for a, b in zip(self.child_lo[rest[inner]], self.child_hi[rest[inner]], strict=True)]
            front = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        compared = 0
        if doubtful:
            some = np.concatenate(doubtful)
            compared = len(some)
            chosen[some] = best = squared(self.points[some], entries).argmin(1)
            np.add.at(counts, best, self.weights[some])
            np.add.at(sums, best, self.points[some] * self.weights[some][:, None])
        return chosen, counts, sums, compared


def _freeze_block(vectors: np.ndarray, parts: int) -> bytes:
    """The trees of a block, with the point of every vector, as bytes."""
    out, width = {}, vectors.shape[1] // parts
    for p in range(parts):
        points, at, weights = np.unique(vectors[:, p * width : (p + 1) * width], axis=0, return_inverse=True, return_counts=True)
        out |= {f"{p}_{n}": v for n, v in CoverTree(points, weights).pack().items()}
        out[f"{p}_at"] = at.reshape(-1).astype(np.int32)
    held = io.BytesIO()
    np.savez(held, **out)
    return held.getvalue()


def _thaw_block(data: bytes, parts: int) -> Iterator[tuple[CoverTree, np.ndarray]]:
    with np.load(io.BytesIO(data)) as held:
        for p in range(parts):
            mine = {n.split("_", 1)[1]: held[n] for n in held.files if n.startswith(f"{p}_")}
            at = mine.pop("at")
            yield CoverTree.unpack(mine), at


# ---- Spark -----------------------------------------------------------------------
def whole_vectors(df: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): usable vectors as integers ``floor(scale * x)``.

    Null vectors, vectors with null or non-finite components, empty ones and
    those of another than the commonest dimension (ties: the smaller) are left
    out. Components must stay below 2**26 / scale in size (then parts of up to 256 numbers have exact distances). A dimension that
    ``parts`` does not divide is filled up with zeros at the end, which changes
    no distance. Rows that repeat an id, and rows without one, stay rows of
    their own. Other columns are dropped, whatever their names.
    """
    vec = F.col("embedding").cast("array<double>")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.filter(vec.isNotNull()).filter(good & (F.size(vec) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(vec, lambda x: F.floor(x * scale).cast("long")).alias("v")
    )
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return rows
    rest = -common.d % parts
    kept = rows.filter(F.size("v") == common.d)
    return kept.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), rest))) if rest else kept


def plant(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """Stored blocks of (ids, labels, trees), each of one partition's vectors."""
    label = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                if not len(part):
                    continue
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
                made = _freeze_block(flat.reshape(len(part), -1), parts)
                lists = [pa.array([part.column(c).to_pylist()], pa.list_(part.column(c).type)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([made], pa.binary())], names=["vec_ids", "labels", "trees"])

    return store(vectors.mapInArrow(run, f"vec_ids array<long>, labels array<{label}>, trees binary"), "trees")


def seeds(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> list[np.ndarray]:
    """A codebook per part: that part of the vectors of smallest id (null ids last, ties by vector); at most ``entries`` rows are gathered."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    if not first:
        return [np.zeros((0, 0), np.int64) for _ in range(parts)]
    return np.split(np.array([r.v for r in first], dtype=np.int64), parts, axis=1)


def lloyd_round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round.

    A task sums over its blocks and sends a row per count or component of a used
    entry; Spark adds them up, so the driver gets one number per codebook value.
    """
    parts, (k, w) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, k, w + 1), dtype=np.int64)
        for batch in batches:
            for data in batch.column("trees"):
                for p, (tree, _) in enumerate(_thaw_block(data.as_py(), parts)):
                    _, counts, sums, _ = tree.assign(books[p])
                    totals[p, :, 0] += counts
                    totals[p, :, 1:] += sums
        used = np.flatnonzero(np.repeat(totals[:, :, 0].reshape(-1) > 0, w + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(totals.reshape(-1)[used])], names=["slot", "value"])

    partial = blocks.select("trees").mapInArrow(run, "slot long, value long")
    added = partial.groupBy("slot").agg(F.sum("value").alias("value")).collect()
    totals = np.zeros((parts, k, w + 1), dtype=np.int64)
    for r in added:
        totals.reshape(-1)[r.slot] = r.value
    out = []
    for p, book in enumerate(books):
        counts = totals[p, :, :1]
        out.append(np.where(counts > 0, totals[p, :, 1:] // np.maximum(counts, 1), book))  # floor, also below zero
    return out


def train(vectors: DataFrame, blocks: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS) -> list[np.ndarray]:
    books = seeds(vectors, entries, parts)
    for _ in range(rounds if books[0].size else 0):
        books = lloyd_round(blocks, books)
    return books


def encode(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every vector of the blocks."""
    label = blocks.schema["labels"].dataType.elementType.simpleString()
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column("trees")):
                ids, labels = batch.column("vec_ids")[i].values, batch.column("labels")[i].values
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p, (tree, at) in enumerate(_thaw_block(data.as_py(), parts)):
                    chosen, *_ = tree.assign(books[p])
                    gap = tree.points - books[p][chosen]
                    codes[:, p] = chosen[at]
                    error += (gap * gap).sum(1)[at]
                hexed = codes.tobytes().hex()
                text = [hexed[2 * parts * j : 2 * parts * (j + 1)] for j in range(len(ids))]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels, null labels together."""
    keyed = coded.withColumns({"_none": F.col("label").isNull(), "_label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    totals = keyed.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"))
    return lookup(keyed, totals, ["_none", "_label"]).drop("_none", "_label")


def codebooks_sha256(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for book in books for x in book.reshape(-1).tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def compress(df: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable vector.

    Fewer vectors than ``entries`` (at most 256) give smaller codebooks; an empty table gives no
    rows. Ties go to the smaller entry, and entries that nobody takes stay.
    """
    vectors = whole_vectors(df, parts, scale)
    blocks = plant(vectors, parts)
    books = train(vectors, blocks, entries, rounds, parts)
    coded = store(encode(blocks, books), "codes")
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))
