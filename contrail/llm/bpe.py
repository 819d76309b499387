"""Byte-pair encoding by an index of pair occurrences, and decoding.

The pre-tokens of a block of a partition are found and hashed with array
operations, and the distinct ones that the task has not met are laid end to end.
An index maps every pair that has a merge to its positions there. The active
merges are applied in ascending rank; a merge takes all its positions, and the
pairs it makes with its neighbours enter the lists of their own merges, whose
ranks are higher, since no merge can need a token before the one that makes it.
Positions whose pair has gone are passed over when their list comes up.

The vocabulary is a ``tokenizers`` file with byte-level BPE. Its added tokens are
split off first, as that library does; they must take no more than their own text.
Pre-tokens count as equal by a 64-bit hash and their length.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import textbytes as tb

VOCABULARY = "byte_bpe_50k.json"
BLOCK = 1 << 20  # characters worked on together; a longer word stands alone
CACHE = 1 << 24  # bytes of pre-tokens with known ids in a task
FEW = 24  # fewer positions are merged one by one
GONE = -1  # no symbol

# Classes of characters.
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 255
# Letters that make a pre-token of their own with the apostrophe before them.
AFTER_APOSTROPHE = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_letters() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 stands for itself; the other bytes, ascending, take the
    code points from 256.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of ranges laid end to end."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Classes:
    """Code points to classes; the library's own tables decide, once per code point met."""

    def __init__(self, split):
        self._split = split
        self._known = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self._known[32] = SPACE  # the one that runs take along

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self._known[points]
        if (found == UNKNOWN).any():
            for p in np.unique(points[found == UNKNOWN]).tolist():
                self._known[p] = self._ask(chr(p))
            found = self._known[points]
        return found

    def _ask(self, c: str) -> int:
        spans = [span for _, span in self._split(f"a{c}1")]
        if (0, 2) in spans:
            return LETTER
        if (1, 3) in spans:
            return NUMBER
        return OTHER if len(self._split(f"!{c}!")) == 1 else SPACE


class Cache:
    """Pre-tokens with known ids in a task: sorted hashes, and places in a pool of ids."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.size = np.zeros(0, "<u4"), 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes, -1 for unknown ones."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray, size: int) -> None:
        at = np.cumsum(counts) - counts + len(self.pool)
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every)
        self.hashes = every[order]
        self.at = np.concatenate([self.at, at])[order]
        self.n = np.concatenate([self.n, counts])[order]
        self.pool = np.concatenate([self.pool, ids])
        self.size += size


class Vocabulary:
    """Merges, ids and byte strings of one file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, pre = told["model"], told["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or told["normalizer"]:
            raise ValueError(f"{path}: not a byte-level BPE without prefix space and normaliser")
        letters, ids = byte_letters(), model["vocab"]
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for c, b in letters.items():
            self.byte_ids[b] = ids[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(self.merges)}
        added = told.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: added tokens that take more than their own text")
        self.base = 1 + max([*ids.values(), *(t["id"] for t in added)])
        keys = np.array([a * self.base + b for a, b, _ in self.merges], dtype=np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pairs = keys[self.pair_ranks]
        bytes_of = [b""] * self.base
        for t, i in ids.items():
            bytes_of[i] = bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        for t in added:
            bytes_of[t["id"]] = t["content"].encode()
        self.token_n = np.array([len(b) for b in bytes_of], dtype=np.int64)
        self.token_at = np.cumsum(self.token_n) - self.token_n
        self.token_bytes = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.added = {t["content"].encode(): t["id"] for t in added}
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, names))) if names else None
        self._classes = Classes(Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str)

    # ---- pre-tokens ------------------------------------------------------------
    def starts(self, points: np.ndarray, cuts: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Where pre-tokens of texts laid end to end start.

        ``cuts`` are the starts of stretches that know nothing of each other, with
        the end last; ``whole`` tells which of them are one pre-token. A run of
        letters, digits or other signs takes one blank before it along; a run of
        white space before such a run gives its last character away; an
        apostrophe that starts a pre-token takes the fixed endings.
        """
        n = len(points)
        kinds = self._classes.of(points)
        first = np.zeros(n + 1, dtype=bool)
        first[cuts] = True
        turn = first[:n].copy()
        turn[1:] |= kinds[1:] != kinds[:-1]
        start = turn.copy()
        solid = kinds != SPACE
        # A run of other than white space with white space before it, in one stretch.
        at = np.flatnonzero(turn[1:] & solid[1:] & ~solid[:-1] & ~first[1:n]) + 1
        start[at - 1] = True
        start[at[points[at - 1] == 32]] = False
        quote = np.flatnonzero((points == 39) & start)
        for letters in AFTER_APOSTROPHE:
            code, m = [ord(c) for c in letters], len(letters)
            here = quote[quote + m < n]
            for j, c in enumerate(code):
                here = here[(points[here + 1 + j] == c) & ~first[here + 1 + j]]
            start[here + 1] = False
            behind = here + 1 + m
            start[behind[behind < n]] = True
        inside = spread(cuts[:-1][whole], np.diff(cuts)[whole])
        start[inside] = first[inside]
        return start

    def _stretches(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between added tokens, and those (True); long text is cut before white space behind other signs."""
        at = 0
        for m in self._added.finditer(text) if self._added else ():
            yield from self._short(text[at : m.start()])
            yield m.group(), True
            at = m.end()
        yield from self._short(text[at:] if at else text)

    @staticmethod
    def _short(text: str) -> Iterator[tuple[str, bool]]:
        at = 0
        while len(text) - at > BLOCK:
            gap = re.compile(r"(?<=[^\s])\s").search(text, at + BLOCK)
            if not gap:
                break
            yield text[at : gap.start()], False
            at = gap.start()
        if at < len(text):
            yield (text[at:] if at else text), False

    # ---- encoding --------------------------------------------------------------
    def encode(self, texts: Iterable[str], cache: Cache) -> Iterator[np.ndarray]:
        """The ids of each text; ``cache`` carries known pre-tokens on."""
        block: list[tuple[str, bool]] = []  # stretches
        owners: list[int] = []
        held: dict[int, list[np.ndarray]] = {}
        size = done = 0

        def flush() -> None:
            for owner, ids in zip(owners, self._encode(block, cache), strict=True):
                held[owner].append(ids)
            block.clear()
            owners.clear()

        for number, text in enumerate(texts):
            held[number] = []
            for stretch in self._stretches(text):
                if block and size + len(stretch[0]) > BLOCK:
                    flush()
                    size = 0
                block.append(stretch)
                owners.append(number)
                size += len(stretch[0])
            if not block or owners[0] == number:  # all texts before are complete
                while done < number:
                    yield _joined(held.pop(done))
                    done += 1
        flush()
        for owner in sorted(held):
            yield _joined(held[owner])

    def _encode(self, block: list[tuple[str, bool]], cache: Cache) -> list[np.ndarray]:
        if not block:
            return []
        points = np.frombuffer("".join(t for t, _ in block).encode("utf-32-le"), np.uint32)
        cuts = np.concatenate([[0], np.cumsum([len(t) for t, _ in block])])
        start = np.flatnonzero(self.starts(points, cuts, np.array([w for _, w in block])))
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer("".join(t for t, _ in block).encode(), np.uint8)
        lo = byte_at[start]
        hi = np.append(lo[1:], len(data))
        hashes, first, which = np.unique(tb.span_hashes(data, lo, hi), return_index=True, return_inverse=True)
        place = cache.find(hashes)
        if (place < 0).any():
            size = int((hi - lo)[first[place < 0]].sum())
            if cache.size + size > CACHE:
                cache.clear()
                place = np.full(len(hashes), -1)
                size = int((hi - lo)[first].sum())
            fresh = first[place < 0]
            ids, counts = self.merge(data, lo[fresh], hi[fresh])
            cache.add(hashes[place < 0], ids, counts, size)
            place = cache.find(hashes)
        at, counts = cache.at[place][which], cache.n[place][which]
        ids = cache.pool[spread(at, counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(start, cuts)]
        return [ids[a:b] for a, b in pairwise(ends.tolist())]

    def merge(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, their counts) of the pre-tokens ``data[lo:hi]``."""
        n_bytes = hi - lo
        n = int(n_bytes.sum())
        symbols = data[spread(lo, n_bytes)]
        stops = np.cumsum(n_bytes)
        last = np.zeros(n, dtype=bool)
        last[stops - 1] = True

        # Symbols, the place behind and the place before each; place n stands behind every word.
        cells = [array("q", bytes(8 * (n + 1))) for _ in range(3)]
        ids, after, before = cells
        ids_, after_, before_ = (np.frombuffer(c, np.int64) for c in cells)
        ids_[:n], ids_[n] = self.byte_ids[symbols], GONE
        after_[:n] = np.where(last, n, np.arange(1, n + 1))
        before_[1:n] = np.where(last[:-1], -1, np.arange(n - 1))
        before_[0] = -1

        index: dict[int, tuple[list, list]] = {}  # rank: single positions, arrays of positions
        heap: list[int] = []

        def listed(q: int) -> tuple[list, list]:
            if q not in index:
                index[q] = ([], [])
                heapq.heappush(heap, q)
            return index[q]

        def enter(pairs: np.ndarray, places: np.ndarray) -> None:
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            hit = self.pairs[at] == pairs
            ranks, places = self.pair_ranks[at[hit]], places[hit]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            first = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
            for x, y in pairwise([*first, len(ranks)]):
                few, many = listed(int(ranks[x]))
                if y - x < FEW:
                    few.extend(places[x:y].tolist())
                else:
                    many.append(places[x:y])

        inside = np.flatnonzero(~last)
        enter(ids_[inside] * self.base + ids_[inside + 1], inside)
        rank, merges = self.rank, self.merges
        while heap:
            r = heapq.heappop(heap)
            left, right, made = merges[r]
            few, many = index.pop(r)
            if many and left != right:  # no two of its positions can overlap
                at = np.concatenate([*many, np.array(few, dtype=np.int64)])
                nxt = after_[at]
                ok = (ids_[at] == left) & (ids_[nxt] == right)
                at, nxt = at[ok], nxt[ok]
                ids_[at], ids_[nxt] = made, GONE
                behind = after_[nxt]
                after_[at] = behind
                before_[behind] = at
                front = before_[at]
                # Where the neighbour in front is merged as well, the pair is its own to enter.
                mine = (front >= 0) & (ids_[front] != made)
                followed = behind < n
                enter(
                    np.concatenate([made * self.base + ids_[behind[followed]], ids_[front[mine]] * self.base + made]),
                    np.concatenate([at[followed], front[mine]]),
                )
                continue
            for i in sorted(few + [x for places in many for x in places.tolist()]):
                j = after[i]
                if ids[i] != left or ids[j] != right:
                    continue
                ids[i], ids[j] = made, GONE
                k = after[i] = after[j]
                before[k] = i
                if (q := rank.get((made, ids[k]))) is not None:
                    listed(q)[0].append(i)
                p = before[i]
                if p >= 0 and (q := rank.get((ids[p], made))) is not None:
                    listed(q)[0].append(p)
        alive = ids_[:n] != GONE
        out = ids_[:n][alive].astype("<u4")
        counts = np.diff(np.cumsum(alive)[stops - 1], prepend=0)
        for i in np.flatnonzero(np.isin(n_bytes, [len(a) for a in self.added])).tolist():  # added tokens are words of their own
            if (token := self.added.get(data[lo[i] : hi[i]].tobytes())) is not None:
                end = int(counts[: i + 1].sum())
                out = np.concatenate([out[: end - counts[i]], np.array([token], "<u4"), out[end:]])
                counts[i] = 1
        return out, counts

    # ---- decoding --------------------------------------------------------------
    def decode(self, ids: bytes) -> str:
        """The text of ids; unknown ids are left out, bytes that are no UTF-8 become U+FFFD."""
        found = np.frombuffer(ids, "<u4")
        if len(found) and found.max() >= self.base:
            found = found[found < self.base]
        n = self.token_n[found]
        return self.token_bytes[spread(self.token_at[found], n)].tobytes().decode("utf-8", "replace")


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, "<u4"), *parts])


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(path or public_tokenizers.path(VOCABULARY))


# ---- Spark -----------------------------------------------------------------------
def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Rows of about a block of a string column; a longer text stands alone."""
    _, offsets = tb.columns(batch.column(column))
    at = 0
    while at < len(batch):
        end = int(np.searchsorted(offsets, offsets[at] + BLOCK, side="right")) - 1
        end = min(max(end, at + 1), len(batch))
        yield batch.slice(at, end - at)
        at = end


def encode_texts(docs: DataFrame, tokenizer: str | None = None, decoded: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its whole text, little-endian unsigned 32-bit values.

    With ``decoded`` also a column of that name, decoded from the ids in the same
    task. A null text is empty and has no ids. Repeated rows and ids, and null
    ids, stay rows of their own; other columns are dropped, whatever their names.
    ``tokenizer`` is a path on the executors; by default the installed public
    50k byte vocabulary.
    """
    names = ["doc_id", "ids", *([decoded] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = vocabulary(tokenizer), Cache()
        for batch in batches:
            for part in _slices(batch, "text"):
                ids = [x.tobytes() for x in known.encode(part.column("text").to_pylist(), cache)]
                more = [pa.array(map(known.decode, ids), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), *more], names=names)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary" + (f", `{decoded}` string" if decoded else ""))


def decode_ids(encoded: DataFrame, tokenizer: str | None = None, column: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in the column ``to``, which is replaced; null ids give an empty text."""
    kept = encoded.drop(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary(tokenizer).decode
        for batch in batches:
            texts = [decode(x or b"") for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, `{to}` string")
