"""Token counts that follow edits.

A document is kept as pre-tokens in leaves of some each, under a segment tree of
character and token sums. Edits are taken left to right in one pass over the new
text. For an edit, pre-tokens are split again from one before the first that it
touches until a boundary meets an old one behind the edit; only these are counted
again, and the sums above their leaves follow. The pre-token pattern looks ahead
only, and no further than the pre-token behind, so before the region and from a
common boundary on nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 16  # pre-tokens
KNOWN = 200_000  # pre-tokens whose counts a task remembers

#: Personal data: mail addresses and IPv4 addresses.
PERSONAL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\b(?:\d{1,3}\.){3}\d{1,3}\b"
MASK = "[masked]"


class Counter:
    """Tokens of pre-tokens of the public byte-level vocabulary."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import regex

        from contrail.llm.packing import _encoder

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encode = _encoder(path or public_tokenizers.path("byte_bpe_50k.json"))
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = len(self.encode(p))
        return [known[p] for p in pieces]


class Tree:
    """Segment tree over the leaves: (characters, tokens) sums."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.n = max(1, len(chars))
        self.width = 1 << (self.n - 1).bit_length()
        level = np.zeros((self.width, 2), dtype=np.int64)
        level[: len(chars), 0], level[: len(tokens), 1] = chars, tokens
        self.levels = [level]
        while len(level) > 1:
            level = level[0::2] + level[1::2]
            self.levels.append(level)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][0, 1])

    @property
    def chars(self) -> int:
        return int(self.levels[-1][0, 0])

    def put(self, leaf: int, chars: int, tokens: int) -> int:
        """Change a leaf; gives the number of sums touched."""
        change = np.array([chars, tokens]) - self.levels[0][leaf]
        for level in self.levels:
            level[leaf] += change
            leaf //= 2
        return len(self.levels)


class Document:
    """A text with its tree; ``counted`` tells how many pre-tokens were encoded, ``touched`` how many sums changed."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.touched = text, counter, 0
        pieces = counter.pattern.findall(text)
        self.counted = len(pieces)
        self.ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        self.counts = np.array(counter.counts(pieces), dtype=np.int64)
        self.leaf = np.arange(len(pieces)) // LEAF
        self.tree = Tree(*self._sums())

    def _sums(self, leaves: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        n = leaves or (int(self.leaf[-1]) + 1 if len(self.leaf) else 1)
        sizes = np.diff(self.ends, prepend=0)
        return tuple(np.bincount(self.leaf, x, n).astype(np.int64) for x in (sizes, self.counts))

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end``."""
        self.apply([(start, end, new)])

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace characters ``start`` to ``end`` by ``new`` for each of the edits, which go up and do not overlap."""
        if not edits:
            return
        if any(b[0] < a[1] for a, b in pairwise(edits)):
            raise ValueError("edits must go up and not overlap")
        parts, at = [], 0
        for start, end, new in edits:
            parts += [self.text[at:start], new]
            at = end
        text = "".join([*parts, self.text[at:]])
        starts = np.array([e[0] for e in edits])
        # The first pre-token of each edit's region: one before the first that reaches the edit.
        region = np.maximum(np.searchsorted(self.ends, starts, side="left") - 1, 0).tolist()
        begin = [int(self.ends[t - 1]) if t else 0 for t in region]
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        changed: set[int] = set()
        shift = kept = i = 0
        while i < len(edits):
            first = max(region[i], kept)
            made.append((self.ends[kept:first] + shift, self.counts[kept:first], self.leaf[kept:first]))
            pieces, ends = [], []
            delta, till, kept = shift + len(edits[i][2]) - edits[i][1] + edits[i][0], edits[i][1], len(self.ends)
            place = (int(self.ends[first - 1]) if first else 0) + shift
            i += 1
            for m in self.counter.pattern.finditer(text, place):
                pieces.append(m.group())
                ends.append(m.end())
                while i < len(edits) and m.end() - delta > begin[i]:  # the next edit's region is reached
                    delta, till = delta + len(edits[i][2]) - edits[i][1] + edits[i][0], edits[i][1]
                    i += 1
                old = m.end() - delta
                if old >= till:
                    t = int(np.searchsorted(self.ends, old))
                    if t < len(self.ends) and self.ends[t] == old:
                        kept = t + 1
                        break
            else:
                # The text ends here; an edit that is left has its region at the end.
                for start, end, new in edits[i:]:
                    delta += len(new) - end + start
                i = len(edits)
            self.counted += len(pieces)
            low = int(self.leaf[min(first, len(self.leaf) - 1)]) if len(self.leaf) else 0
            high = int(self.leaf[kept - 1]) if kept > first else low
            changed.update(range(low, high + 1))
            spots = low + np.arange(len(pieces)) * (high - low + 1) // max(1, len(pieces))
            made.append((np.array(ends, dtype=np.int64), np.array(self.counter.counts(pieces), dtype=np.int64), spots))
            shift = delta
        made.append((self.ends[kept:] + shift, self.counts[kept:], self.leaf[kept:]))
        self.text = text
        self.ends, self.counts, self.leaf = (np.concatenate(x) for x in zip(*made, strict=True))
        chars, tokens = self._sums(self.tree.n)
        for leaf in sorted(changed):
            self.touched += self.tree.put(leaf, int(chars[leaf]), int(tokens[leaf]))


def count_edited(docs: DataFrame, pattern: str = PERSONAL, mask: str = MASK, tokenizer: str | None = None) -> DataFrame:
    """Token counts of whole texts before and after every match of ``pattern`` becomes ``mask``.

    Columns: doc_id, tokens_before, tokens_after, edits, pretokens (of the text
    before), reencoded (pre-tokens encoded for the edits) and sums (tree sums
    updated). Null and empty texts count 0. Rows that repeat are counted each;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        counter, find = Counter(tokenizer), re.compile(pattern)
        for b in batches:
            rows = []
            for text in b["text"]:
                doc = Document(text or "", counter)
                before, pieces = doc.tree.tokens, doc.counted
                matches = list(find.finditer(text or ""))
                doc.apply([(m.start(), m.end(), mask) for m in matches])
                rows.append((before, doc.tree.tokens, len(matches), pieces, doc.counted - pieces, doc.touched))
            names = ["tokens_before", "tokens_after", "edits", "pretokens", "reencoded", "sums"]
            yield pd.concat([b[["doc_id"]].reset_index(drop=True), pd.DataFrame(rows, columns=names, dtype="int64")], axis=1)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, tokens_before long, tokens_after long, edits long, pretokens long, reencoded long, sums long"
    )
