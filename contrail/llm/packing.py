"""Packing token pieces into windows by Karmarkar-Karp multiway differencing.

Texts are cut to pieces of fixed places, so that a piece's ids are known where
the text is read. Pieces that fill a window stand alone. The others are dealt
by hash into blocks of bounded size; in each block, partial partitions with the
largest imbalance are merged, the heaviest windows of one with the lightest of
the other, until one partition is left. If a window of it exceeds the capacity,
the block is divided again with more windows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import textbytes as tb
from contrail.llm.scratch import store

WINDOW = 2048
PIECE = 512  # longest piece of a text's rest; smaller ones leave less padding
BLOCK = 1500  # pieces of a block, on average
END_ID = 1


def _encoder(path: str):
    """The encoding of ``path`` as ``tokenizers`` gives it: its added tokens are found in the text, too."""
    import base64
    import json

    import public_tokenizers
    import tiktoken

    ranks_path = path.rsplit(".", 1)[0] + ".tiktoken"
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as told:
        added = {t["content"]: t["id"] for t in json.load(told).get("added_tokens") or []}
    found = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: found.encode(text, allowed_special="all")


def token_pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): each text's ids and the end id, cut to pieces.

    A null text is empty and consists of the end id. ``ids`` holds little-endian
    unsigned 32-bit values. Whole windows come first, then pieces of at most
    ``piece`` ids. ``tokenizer`` is a path on the executors; by default the
    installed public 50k byte vocabulary, in the faster of its two forms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode = _encoder(tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
        for batch in batches:
            _, offsets = tb.columns(batch.column("text"))
            for lo, hi in tb.chunks(offsets):
                out: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "doc_tokens", "ids")}
                names = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                texts = batch.column("text").slice(lo, hi - lo).to_pylist()
                for name, text in zip(names, texts, strict=True):
                    ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                    n, at = len(ids), 0
                    while at < n:
                        size = window if n - at >= window else min(piece, n - at)
                        for c, v in zip(out, (name, at, size, n, ids[at : at + size].tobytes()), strict=True):
                            out[c].append(v)
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items()], names=list(out)
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, ids binary"
    )


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, window sums) of a Karmarkar-Karp division into ``k`` windows.

    A partial partition keeps its windows' sums above its lightest one, heavy
    first, and their items as chains, which are linked when windows are merged.
    """
    n = len(sizes)
    link = np.full(n, -1)
    one = lambda i: (sizes[i : i + 1].astype(np.int64), np.array([i]), np.array([i]))
    parts = dict(enumerate(map(one, range(n))))
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    fresh = n
    while len(heap) > 1:
        a, b = parts.pop(heapq.heappop(heap)[1]), parts.pop(heapq.heappop(heap)[1])
        if len(a[0]) < len(b[0]):
            a, b = b, a
        over = max(0, len(a[0]) + len(b[0]) - k)  # windows of both that must share
        la, lb = len(a[0]), len(b[0])
        # Light windows of one meet light windows of the other, crosswise; heavy ones meet empty ones.
        low, high = slice(la - over, la), lb - over
        back = slice(lb - 1, high - 1 if high else None, -1) if over else slice(0, 0)
        sums = np.concatenate([a[0][: la - over], a[0][low] + b[0][back], b[0][:high]])
        link[a[2][low]] = b[1][back]
        heads = np.concatenate([a[1], b[1][:high]])
        tails = np.concatenate([a[2][: la - over], b[2][back], b[2][:high]])
        order = np.argsort(-sums, kind="stable")
        sums, heads, tails = sums[order], heads[order], tails[order]
        spread = int(sums[0] - (sums[-1] if len(sums) == k else 0))
        parts[fresh] = (sums, heads, tails)
        heapq.heappush(heap, (-spread, fresh))
        fresh += 1
    sums, heads, _ = parts[heap[0][1]]
    at = np.empty(n, dtype=np.int64)
    for w, i in enumerate(heads.tolist()):
        while i >= 0:
            at[i] = w
            i = link[i]
    return at, sums


def divide(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of the items, as few as the capacity lets differencing find."""
    total = int(sizes.sum())
    k = max(1, -(-total // capacity))
    while True:
        at, sums = differencing(sizes, k)
        if sums.max() <= capacity:
            return at
        k += max(1, int(k * (sums.max() - capacity) / capacity / 4))


def pack(pieces: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``; needs ``length``.

    ``pieces`` must be a written table: a row is dealt by its place there, so
    repeated rows spread like any others. Rows of length 0 or null take no part.
    An empty table gives no rows.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.filter("length > 0").select(
        *kept, F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("_at")
    )
    loose = rows.filter(F.col("length") < window)
    blocks = max(1, -(-loose.count() // block))
    loose = loose.withColumn("_block", F.pmod("_at", F.lit(blocks)).cast("long"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_at", kind="stable").reset_index(drop=True)
        sizes = g["length"].to_numpy()
        at = divide(sizes, window)
        order = np.lexsort((g["_at"].to_numpy(), at))
        before = np.cumsum(sizes[order]) - sizes[order]
        seq = at[order]
        first = np.r_[True, seq[1:] != seq[:-1]]
        start = np.maximum.accumulate(np.where(first, before, 0))
        out = g.iloc[order].drop(columns=["_at"])
        return out.assign(sequence_id=out.pop("_block") * (1 << 20) + seq, offset=before - start)

    fields = [f for f in rows.schema if f.name != "_at"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    packed = loose.groupBy("_block").applyInPandas(run, f"{schema}, sequence_id long, offset long")
    # Whole windows are numbered by partition and row of the written table, above all numbers of blocks.
    whole = rows.filter(F.col("length") >= window).select(
        *kept,
        (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Token pieces of whole texts with their ids and places in windows."""
    return pack(store(token_pieces(docs, tokenizer), "pieces"))
