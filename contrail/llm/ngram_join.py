"""N-gram Jaccard join: size-aware, with light and heavy sets.

The sets are the distinct word shingles of whole texts; two link when
``q * |A & B| >= p * |A | B|``. Equal sets are first folded to one, so exact
copies cost one row. Then

* *light* sets (size up to the boundary) enumerate their subsets of the size
  that two linked sets must share. Whoever meets in the list of a subset of
  ``k`` elements shares ``k`` elements, so the list is linked to its smallest
  member without comparing pairs;
* *heavy* sets scan inverted lists. A set is dealt into ``m`` hash ranges, and
  the content of each range is a list entry. One differing element spoils one
  range, so a linked pair agrees in at least ``m - d`` ranges, where ``d`` is
  the largest difference a link allows, and meets in the lists of any ``d + 1``
  ranges: a set enters the lists of its first ``d + 1`` ranges with content. ``m``
  comes from the sizes of both, so a set serves every ``m`` its partners may have. Each list is
  first compared with its smallest member only. Members still apart after that
  are compared with each other inside tasks, long lists block by block; only pairs
  whose ranges agree often enough leave the task.

Every candidate is verified on the exact sets. The boundary is the size that
makes the rows of both sides cheapest, from the counts of the small sizes.
Lists never have a limit on members, and no link between different sets is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm import textbytes as tb
from contrail.llm.components import connected, extended
from contrail.llm.scratch import store

SMALL = 64  # sizes for which both sides are priced
VERIFY = 4.0  # price of a heavy set's verification, in list rows
SHORT_LIST = 48  # longest list whose members are all compared at once
CELLS = 1 << 20  # marks of pairs that a task compares at a time
BLOCK = 256  # rows of a block of a longer list
NAMING = 4  # ranges whose long lists name a pair; 15 bits would have to agree by chance in all of them to lose one
BROADCAST_IDS = 1_000_000  # most document ids sent to all executors

SETS = "doc_id long, n_shingles int, h1 long, h2 long, small array<long>"


class Rule:
    """What sizes imply for a link at similarity ``p / q``."""

    def __init__(self, p: int, q: int):
        if not 0 < p <= q:
            raise ValueError("similarity must be in (0, 1]")
        self.p, self.q = p, q

    def partners(self, a: int) -> tuple[int, int]:
        return -(-self.p * a // self.q), self.q * a // self.p

    def shared(self, total: int) -> int:
        """Elements that linked sets of together ``total`` elements share at least."""
        return -(-self.p * total // (self.p + self.q))

    def differ(self, total: int) -> int:
        """Elements in which they differ at most."""
        return total * (self.q - self.p) // (self.q + self.p)

    def ranges(self, d: int) -> int:
        """Ranges for a pair that may differ in ``d`` elements, from a coarse grid."""
        need, m = d + d // 4 + 4, 4
        while m < need:
            m *= 2
        return m

    def ranges_of(self, d: np.ndarray) -> np.ndarray:
        """``ranges`` of many."""
        values, at = np.unique(d, return_inverse=True)
        return np.array([self.ranges(int(v)) for v in values], np.int64)[at]

    @lru_cache(maxsize=100_000)  # noqa: B019
    def grid(self, a: int) -> tuple[tuple[int, int], ...]:
        """(m, largest difference) for every ``m`` that a partner of a set of ``a`` may use."""
        lo, hi = self.partners(a)
        out: dict[int, int] = {}
        for d in range(self.differ(a + lo), self.differ(a + hi) + 1):
            out[self.ranges(d)] = d
        return tuple(out.items())

    @lru_cache(maxsize=1000)  # noqa: B019
    def subset_sizes(self, a: int) -> tuple[int, ...]:
        lo, hi = self.partners(a)
        return tuple(sorted({self.shared(a + b) for b in range(max(lo, 1), hi + 1)} & set(range(1, a + 1))))

    def subsets(self, a: int) -> int:
        return sum(comb(a, k) for k in self.subset_sizes(a))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def range_codes(u: np.ndarray, rule: Rule) -> tuple[list[int], np.ndarray]:
    """The range codes of a sorted set, for every ``m``.

    A code is odd where the set enters the list of the range, and even elsewhere.
    The next five bits of it are the logarithm of ``m``.
    """
    spread = tb.mix(u ^ np.uint64(0x5851F42D4C957F2D))
    sums = np.zeros(len(u) + 1, dtype=np.uint64)
    np.cumsum(spread, out=sums[1:])
    high = u >> np.uint64(32)
    ms, parts = [], []
    for m, d in rule.grid(len(u)):
        at = np.searchsorted((high * np.uint64(m)) >> np.uint64(32), np.arange(m + 1, dtype=np.uint64))
        code = tb.mix(
            (sums[at[1:]] - sums[at[:-1]])
            ^ tb.mix(np.arange(m, dtype=np.uint64) + np.uint64(m << 32))
        )
        code = (code & ~np.uint64(63)) | np.uint64((m.bit_length() - 1) << 1 | 1)
        empty = at[1:] == at[:-1]
        if empty.sum() < m - d:  # an agreeing range with content is certain, among any d + 1 of them
            code[empty | (np.cumsum(~empty) > d + 1)] ^= np.uint64(1)
        ms.append(m)
        parts.append(code)
    return ms, np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _hashes(u: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set; 0 for the empty one."""
    if not len(u):
        return 0, 0
    with np.errstate(over="ignore"):
        both = np.add.reduce(tb.mix(u)), np.add.reduce(tb.mix(u ^ np.uint64(0xD6E8FEB86659FD93)))
    return tuple(int(x.view(np.int64)) for x in both)


def _each_set(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, last row, sets) of stretches of a batch with a text column."""
    data, offsets = tb.columns(batch.column("text"))
    for lo, hi in tb.chunks(offsets):
        hashes, _, _, rows = tb.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, list(tb.shingles(hashes, rows, words))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: set size and two set hashes; small sets in full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _each_set(batch, words):
                both = [_hashes(u) for u in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()),
                        pa.array([len(u) for u in sets], pa.int32()),
                        pa.array([h for h, _ in both], pa.int64()),
                        pa.array([h for _, h in both], pa.int64()),
                        pa.array([_signed(u) if len(u) <= SMALL else None for u in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "small"],
                )

    return _texts(docs).mapInArrow(run, SETS)


def _named_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(sid, h1, text) of the texts of ``ids`` (sid, h1); with a repeated id, other texts may come along."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return _texts(docs).withColumnRenamed("doc_id", "sid").join(ids, "sid")


def list_entries(docs: DataFrame, ids: DataFrame, words: int, rule: Rule) -> DataFrame:
    """(sid, code): the lists that the sets of ``ids`` (sid, h1) enter, straight from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _each_set(batch, words):
                sid, h1 = (batch.column(c).slice(lo, hi - lo).to_numpy() for c in ("sid", "h1"))
                found = [range_codes(u, rule)[1] if len(u) and _hashes(u)[0] == h else np.zeros(0, np.uint64) for u, h in zip(sets, h1, strict=True)]
                found = [c[c & np.uint64(1) == 1] for c in found]
                owner = np.repeat(sid, [len(c) for c in found])
                codes = _signed(np.concatenate([np.zeros(0, np.uint64), *found]))
                yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(codes, pa.int64())], names=["sid", "code"])

    return _named_sets(docs, ids).mapInArrow(run, "sid long, code long")


def _broad(codes: np.ndarray) -> np.ndarray:
    """The upper 15 bits of codes, and below them whether the set enters the list."""
    return ((codes >> np.uint64(48)) & np.uint64(0xFFFE) | codes & np.uint64(1)).astype("<u2")


def coded_sets(docs: DataFrame, ids: DataFrame, words: int, rule: Rule) -> DataFrame:
    """(sid, h1, n_shingles, ms, marks, broad): what moves of the range codes of the sets of ``ids`` (sid, h1).

    ``marks`` are 8 bits of each code, by which pairs are weighed; equal codes have
    equal marks, so no link is lost. ``broad`` has 15 bits of each, and whether the
    set enters the list of the range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _each_set(batch, words):
                sid, h1 = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("sid", "h1"))
                rows = [(i, h, len(u), *range_codes(u, rule)) for i, h, u in zip(sid, h1, sets, strict=True) if len(u) and _hashes(u)[0] == h]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.list_(pa.int32())),
                        pa.array([(r[4] >> np.uint64(56)).astype(np.uint8).tobytes() for r in rows], pa.binary()),
                        pa.array([_broad(r[4]).tobytes() for r in rows], pa.binary()),
                    ],
                    names=["sid", "h1", "n_shingles", "ms", "marks", "broad"],
                )

    return _named_sets(docs, ids).mapInArrow(
        run, "sid long, h1 long, n_shingles int, ms array<int>, marks binary, broad binary"
    )


def boundary(sizes: DataFrame, rule: Rule) -> int:
    """The largest light size: the cut that makes the rows of both sides fewest."""
    counts = {
        r["n_shingles"]: r["n"]
        for r in sizes.filter(F.col("n_shingles").between(1, SMALL))
        .groupBy("n_shingles").agg(F.count(F.lit(1)).alias("n")).collect()  # at most SMALL rows
    }
    light, heavy = {}, {}
    for n, c in counts.items():
        light[n] = c * rule.subsets(n)
        heavy[n] = c * (sum(d + 1 for _, d in rule.grid(n)) + VERIFY)
    price = {
        x: sum(v for n, v in light.items() if n <= x) + sum(v for n, v in heavy.items() if n > x)
        for x in range(SMALL + 1)
    }
    return min(price, key=lambda x: (price[x], x))


def _light_links(reps: DataFrame, rule: Rule, limit: int) -> DataFrame:
    """Links among sets of at most ``limit`` elements, from the lists of their subsets."""
    from itertools import combinations

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for sid, n, small in zip(batch["sid"], batch["n_shingles"], batch["small"], strict=True):
                u = np.sort(np.asarray(small).astype(np.int64).view(np.uint64))
                spread = [tb.mix(u ^ np.uint64(s)) for s in (0x27D4EB2F165667C5, 0x165667B19E3779F9)]
                for k in rule.subset_sizes(int(n)):
                    rows = combinations(range(int(n)), k)
                    while chosen := [c for _, c in zip(range(4096), rows)]:
                        at = np.array(chosen)
                        yield pd.DataFrame(
                            {
                                "sid": np.full(len(at), sid), "n": np.full(len(at), n), "k": np.full(len(at), k),
                                **{f"s{i}": _signed(tb.mix(x[at].sum(axis=1, dtype=np.uint64))) for i, x in enumerate(spread)},
                            }
                        )

    lists = (
        reps.filter(F.col("n_shingles").between(1, limit)).select("sid", "n_shingles", "small")
        .mapInPandas(run, "sid long, n int, k int, s0 long, s1 long")
    )
    heads = lists.groupBy("k", "s0", "s1").agg(F.min(F.struct("n", "sid")).alias("head"), F.count(F.lit(1)).alias("c"))
    p, q = rule.p, rule.q
    return (
        lists.join(heads.filter("c > 1"), ["k", "s0", "s1"])
        .filter(F.col("sid") != F.col("head.sid"))
        # Linked when the shared k elements suffice for both sizes.
        .filter(F.col("k") * (p + q) >= p * (F.col("n") + F.col("head.n")))
        .select(F.col("head.sid").alias("a"), F.col("sid").alias("b")).distinct()
    )


def _agreeing(rule: Rule, na: int, ms_a, marks_a, nb: int, ms_b, marks_b) -> int:
    """Ranges in which two sets agree beyond what a link needs; negative: no link."""
    lo, hi = rule.partners(na)
    if not lo <= nb <= hi:
        return -1
    d = rule.differ(na + nb)
    m = rule.ranges(d)
    views = []
    for ms, marks in ((ms_a, marks_a), (ms_b, marks_b)):
        start = 0
        for x in ms:
            if x == m:
                views.append(marks[start : start + m] | 1)
                break
            start += x
    if len(views) < 2:
        return -1
    return int((views[0] == views[1]).sum()) - (m - d)


def _promising(pairs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose ranges agree often enough for a link, with the surplus."""
    cols = ["n_shingles", "ms", "marks"]
    left = reps.select(F.col("sid").alias("a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    right = reps.select(F.col("sid").alias("b"), *[F.col(c).alias(f"{c}_b") for c in cols])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            over = [
                _agreeing(rule, na, ma, np.frombuffer(a, np.uint8), nb, mb, np.frombuffer(b, np.uint8))
                for na, ma, a, nb, mb, b in zip(x.n_shingles_a, x.ms_a, x.marks_a, x.n_shingles_b, x.ms_b, x.marks_b, strict=True)
            ]
            yield x[["a", "b"]].assign(over=over)

    wide = pairs.join(left, "a").join(right, "b")
    return wide.mapInPandas(run, "a long, b long, over int").filter("over >= 0")


def _exact_sets(docs: DataFrame, ids: DataFrame, words: int, repeated: bool, *names: str) -> DataFrame:
    """``names`` of every row of ``ids`` (sid, h1, ...) and the sorted set of its text in bytes (``elems``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _each_set(batch, words):
                h1 = batch.column("h1").slice(lo, hi - lo).to_pylist()
                keep = np.array([len(u) > 0 and _hashes(u)[0] == h for u, h in zip(sets, h1, strict=True)], dtype=bool)
                columns = [batch.column(n).slice(lo, hi - lo).filter(pa.array(keep)) for n in names]
                elems = pa.array([u.tobytes() for u, k in zip(sets, keep, strict=True) if k], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, elems], names=[*names, "elems"])

    found = _named_sets(docs, ids).mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", elems binary")
    return found.dropDuplicates([*names]) if repeated else found


def _verified(
    pairs: DataFrame, docs: DataFrame, reps: DataFrame, words: int, rule: Rule, repeated: bool
) -> DataFrame:
    """The pairs that link, by their exact sets.

    Both sets come straight from the texts: that of ``b`` once per pair, under
    the name of ``a``, and that of ``a`` once, so one join brings them together.
    """
    pairs = store(pairs.select("a", "b"), "pairs")
    hashes = reps.select("sid", "h1")
    lefts = store(pairs.select(F.col("a").alias("sid")).distinct().join(hashes, "sid"), "needed")
    rights = store(pairs.select(F.col("b").alias("sid"), "a").join(hashes, "sid"), "needed")

    p, q = rule.p, rule.q

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            good = []
            for ea, eb in zip(x.ea, x.eb, strict=True):
                a, b = np.frombuffer(ea, np.uint64), np.frombuffer(eb, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(q * both >= p * (len(a) + len(b) - both))
            yield x.loc[good, ["a", "b"]]

    left = _exact_sets(docs, lefts, words, repeated, "sid").select(F.col("sid").alias("a"), F.col("elems").alias("ea"))
    right = _exact_sets(docs, rights, words, repeated, "sid", "a").select("a", F.col("sid").alias("b"), F.col("elems").alias("eb"))
    return right.join(left, "a").mapInPandas(check, "a long, b long").distinct()


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come sorted by ``code``, in parts that end between lists."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        code = batch.column("code").to_numpy()
        ends = np.flatnonzero(code != code[-1])
        end = int(ends[-1]) + 1 if len(ends) else 0  # where the last list begins
        before = held and held[-1].column("code")[-1].as_py() != code[0]
        if end or before:
            yield pa.Table.from_batches([*held, batch.slice(0, end)])
            held = [batch.slice(end)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _list_pairs(lists: pa.Table, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Members of the same list in different components whose marks agree often enough for a link, without the head's pairs."""
    code, head, sid, comp, size = (lists.column(c).to_numpy() for c in ("code", "head", "sid", "component", "n_shingles"))
    none = np.zeros(0, np.int64)
    if not len(code):
        return none, none
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    counts = np.diff(np.r_[starts, len(code)])
    sides = []
    for k in np.unique(counts).tolist():
        i, j = np.triu_indices(k, 1)
        first = starts[counts == k][:, None]
        sides.append(np.stack([(first + i).ravel(), (first + j).ravel()]))
    x, y = np.concatenate(sides, axis=1)
    size = size.astype(np.int64)
    total, m = size[x] + size[y], np.int64(1) << ((code[x] >> 1) & 31)
    d = total * (rule.q - rule.p) // (rule.q + rule.p)
    ok = (comp[x] != comp[y]) & (sid[x] != sid[y]) & (sid[x] != head[x]) & (sid[y] != head[y])
    ok &= rule.q * np.minimum(size[x], size[y]) >= rule.p * np.maximum(size[x], size[y])
    ok[ok] = rule.ranges_of(d[ok]) == m[ok]
    x, y, m, d = x[ok], y[ok], m[ok], d[ok]
    found = [np.stack([none, none])]
    marks = lists.column("marks").cast(pa.large_binary()).combine_chunks()
    offsets, data = (np.frombuffer(b, t) for b, t in zip(marks.buffers()[1:], (np.int64, np.uint8), strict=True))
    offsets = offsets[marks.offset :]
    for n in np.unique(m).tolist():
        of_m = np.flatnonzero(m == n)
        step = max(1, CELLS // n)
        for lo in range(0, len(of_m), step):
            at = of_m[lo : lo + step]
            cells = np.arange(n)
            same = data[offsets[x[at]][:, None] + cells] == data[offsets[y[at]][:, None] + cells]
            at = at[same.sum(axis=1) >= n - d[at]]
            found.append(np.sort(np.stack([sid[x[at]], sid[y[at]]]), axis=0))
    a, b = np.unique(np.concatenate(found, axis=1), axis=1)
    return a, b


def _block_pairs(g: pd.DataFrame, rule: Rule) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows) of two blocks of a long list that are of different components and agree often enough for a link."""
    i, j, head, code = (int(g[c].iloc[0]) for c in ("i", "j", "head", "code"))
    m, here = 1 << (code >> 1 & 31), _broad(np.array([code], np.int64).view(np.uint64))[0]
    sid, comp, block, size = (g[c].to_numpy() for c in ("sid", "component", "own", "n_shingles"))
    size = size.astype(np.int64)
    broad = np.frombuffer(b"".join(g["broad"]), "<u2").reshape(len(g), m)
    for x in range(len(g)):
        if block[x] != i or sid[x] == head:
            continue
        d = (size + size[x]) * (rule.q - rule.p) // (rule.q + rule.p)
        ok = (block == j) & (comp != comp[x]) & (sid != head) & ((sid > sid[x]) | (i != j))
        ok &= rule.q * np.minimum(size, size[x]) >= rule.p * np.maximum(size, size[x])
        ok[ok] = rule.ranges_of(d[ok]) == m
        if ok.any():
            near = np.flatnonzero(ok)
            same = (broad[near] | 1) == (broad[x] | 1)
            # Of all lists that a pair shares, only those of its first ranges name it.
            both = same & (broad[near] & broad[x] & 1 == 1)
            named = (both & (both.cumsum(axis=1) <= NAMING) & (broad[x] == here)).any(axis=1)
            ys = near[(same.sum(axis=1) >= m - d[near]) & named]
            if len(ys):
                yield x, ys


def _block_links(g: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """Links (a, b) that join the components of two blocks, by the exact sets (``elems``): fewer than there are components."""
    sets = [np.frombuffer(e, np.uint64) for e in g["elems"]]
    starts = np.cumsum([0, *map(len, sets)])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    has = np.zeros(len(values), dtype=bool)
    sid, root, sizes = g["sid"].to_numpy(), g["component"].to_numpy().copy(), np.diff(starts)
    out = []
    for x, ys in _block_pairs(g, rule):
        ys = ys[root[ys] != root[x]]
        has[at[starts[x] : starts[x + 1]]] = True
        common = np.array([has[at[starts[y] : starts[y + 1]]].sum() for y in ys], dtype=np.int64)
        has[at[starts[x] : starts[x + 1]]] = False
        for y in ys[rule.q * common >= rule.p * (sizes[x] + sizes[ys] - common)]:
            if root[y] != root[x]:
                root[root == root[y]] = root[x]
                out.append(sorted((int(sid[x]), int(sid[y]))))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _apart(
    lists: DataFrame, at: DataFrame, docs: DataFrame, reps: DataFrame, words: int, rule: Rule, repeated: bool
) -> tuple[DataFrame, DataFrame]:
    """What shares a list but no component, without the pairs of list heads: (pairs, links).

    The pairs come from short lists and agree often enough for a link. The links
    come from longer lists; they are decided on the exact sets, and as many as
    join what links there.
    """
    at = at.select(F.col("node").alias("sid"), "component")
    rows = lists.join(at, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    mixed = (
        rows.groupBy("code")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"))
        .filter("lo <> hi")
    )
    rows = store(rows.join(mixed.select("code", "c"), "code"), "mixed")
    # A list is of one m, so its rows carry the marks of that m only.
    m = F.expr("shiftleft(1, CAST(shiftright(code, 1) & 31 AS INT))")
    few = rows.filter(F.col("c") <= SHORT_LIST).join(reps.select("sid", "n_shingles", "ms", "marks"), "sid")
    few = (
        few.withColumn("marks", F.substring("marks", m - F.col("ms")[0] + 1, m))
        .select("code", "head", "sid", "component", "n_shingles", "marks")
        .repartition("code").sortWithinPartitions("code")
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_lists(batches):
            a, b = _list_pairs(part, rule)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    pairs = few.mapInArrow(weigh, "a long, b long")

    # Longer lists, cut to blocks; every pair of blocks is one task-sized group.
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    long = rows.filter(F.col("c") > SHORT_LIST).join(reps.select("sid", "h1", "n_shingles", "ms", "broad"), "sid")
    long = (
        long.withColumn("own", own).withColumn("broad", F.substring("broad", 2 * (m - F.col("ms")[0]) + 1, 2 * m))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    )

    columns = ["code", "i", "j", "head", "sid", "component", "own", "n_shingles", "broad", "h1"]
    types = "code long, i int, j int, head long, sid long, component long, own int, n_shingles int, broad binary, h1 long"

    def near(g: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(g), dtype=bool)
        for x, ys in _block_pairs(g, rule):
            seen[x] = seen[ys] = True
        return g[seen]

    # Pairs stay in the task: a group names its members that have one, and these come again with their exact sets.
    met = store(long.select(*columns).groupBy("code", "i", "j").applyInPandas(near, types), "met")
    ids = store(met.select("sid", "h1").distinct(), "needed")
    sets = met.drop("h1").join(_exact_sets(docs, ids, words, repeated, "sid"), "sid")
    wide = sets.groupBy("code", "i", "j").applyInPandas(lambda g: _block_links(g, rule), "a long, b long")
    return pairs.distinct(), wide.distinct()


def similar_groups(docs: DataFrame, words: int = 5, p: int = 8, q: int = 10) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Links need similarity of at least ``p / q`` between the sets of distinct
    ``words``-word shingles of the lower-cased (A-Z) text. A text with fewer
    words is one shingle; null, empty and blank texts have size 0 and link
    with nothing. ``component_id`` is the smallest ``doc_id`` reachable. Rows
    with a null ``doc_id`` cannot be named: they take no part and get null.
    Rows that repeat a ``doc_id`` count as one document. Other columns are
    ignored; an empty table gives no rows.
    """
    rule = Rule(p, q)
    sets = store(shingle_sets(docs, words), "shingles")
    repeated = not sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty()
    usable = sets.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "h1", "h2"]
    classes = store(
        usable.groupBy(*same).agg(F.min("doc_id").alias("sid"), F.min("small").alias("small")), "classes"
    )
    limit = boundary(classes, rule)
    light = _light_links(classes, rule, limit)

    # Range codes come from the text of one document per class, and are kept only where a list is shared.
    heavy = classes.filter(F.floor(q * F.col("n_shingles") / p) > limit).select("sid", "h1")
    entries = list_entries(docs, heavy, words, rule)
    entries = entries.distinct() if repeated else entries
    # All members of a list meet once; lists of a single member go no further.
    both = Window.partitionBy("code")
    entries = entries.withColumns({"head": F.min("sid").over(both), "_last": F.max("sid").over(both)})
    lists = store(entries.filter("head <> _last").select("sid", "code", "head"), "lists")
    members = heavy.join(lists.select("sid").distinct(), "sid", "left_semi")
    reps = coded_sets(docs, members, words, rule)
    reps = store(reps.dropDuplicates(["sid"]) if repeated else reps, "members")

    to_head = lists.filter("sid <> head").select(F.col("head").alias("a"), F.col("sid").alias("b")).distinct()
    near = store(_promising(to_head, reps, rule), "near")
    best = Window.partitionBy("b").orderBy(F.desc("over"), "a")
    first = near.withColumn("r", F.row_number().over(best)).filter("r = 1").select("a", "b")
    links = store(
        light.unionByName(_verified(first, docs, reps, words, rule, repeated)), "links"
    )
    at = connected(links)

    # What is still apart: the other pairs with list heads, then members among themselves.
    spots = at.select("node", "component")
    later = (
        near.select("a", "b").join(spots.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(spots.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .filter("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")
        .join(first, ["a", "b"], "left_anti")
    )
    pairs, joined = _apart(lists, at, docs, reps, words, rule, repeated)
    rest = store(later.unionByName(pairs).distinct(), "rest")
    more = store(_verified(rest, docs, reps, words, rule, repeated).unionByName(joined).distinct(), "links")
    if not more.isEmpty():
        at = extended(at, more)

    named = classes.select(*same, "sid").join(
        at.select(F.col("node").alias("sid"), "component"), "sid", "left"
    ).select(*[F.col(c).alias(f"_{c}") for c in same], F.coalesce("component", "sid").alias("component"))
    rows = sets.select("doc_id", *same)
    matched = rows.join(
        named,
        (rows["n_shingles"] == named["_n_shingles"]) & (rows["h1"] == named["_h1"]) & (rows["h2"] == named["_h2"]),
        "left",
    )
    return matched.select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
