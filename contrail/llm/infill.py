"""Fill-in-the-middle by secondary sort.

A text is cut at two units (words with the white space before them). Its parts
leave as pieces of whole units, keyed by row and place in the output; one shuffle
by row with a sort inside the partitions (``repartition`` and
``sortWithinPartitions``, one exchange) lets a task stream the pieces of a row in
output order into a digest. The restoration reads the output again, tells parts
apart by the markers, sorts once more inside the same partitions and streams the
pieces of the original order. No text is held whole unless it is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import textbytes as tb
from contrail.llm.scratch import store

PIECE = 1 << 16  # most bytes of a piece
ROWS = 256  # rows taken out of a batch at a time
# Markers, and the parts of either form in output order (0 prefix, 1 middle, 2 suffix).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FORMS = {
    "plain": ((b"", 0),),
    "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}
_KEY = ["_file", "_row"]
_KEYS = "_file long, _row long"
_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_PIECES = f"{_KEYS}, {_FACTS}, at int, piece binary"
_PARTS = f"{_KEYS}, {_FACTS}, output_sha256 string, part int, at int, piece binary"
_ENDS = 3  # the part number of the row that ends a document


def _draw(seed: int) -> list[Column]:
    """h1 to h4: 8-digit groups of the sha256 of seed and document id (a null id is empty)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _cuts(start: int, stop: int, ends: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Pieces of [start, stop) that end with a unit, or inside one that is larger than ``size``."""
    out = []
    while stop - start > size:
        i = int(np.searchsorted(ends, start + size, side="right")) - 1
        till = int(ends[i]) if i >= 0 and ends[i] > start else start + size
        out.append((start, till))
        start = till
    if stop > start:
        out.append((start, stop))
    return out


def _characters(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def fim_pieces(
    docs: DataFrame, number: list[str] | None = None, seed: int = 42, rate: int = 50, spm_rate: int = 80, size: int = PIECE
) -> DataFrame:
    """Pieces of the transformed texts: (key, facts of the text at piece 0, ``at``, ``piece``).

    Needs ``doc_id`` and ``text``; other columns are ignored, whatever their
    names. ``number`` names a file and a row column that tell rows apart; without
    it the table is written first and numbered by its place there. So repeated
    rows and ids stay apart, and null ids take part. A null text is empty. A
    text that is empty, holds a marker or is not drawn (``rate`` of 100) has the
    form plain and is one part.
    """
    if number is None:
        docs = store(docs.select("doc_id", "text"), "texts").select(
            "*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_i")
        )
        number = ["_f", "_i"]
    rows = docs.select(
        F.xxhash64(number[0]).alias("_file"), F.col(number[1]).cast("long").alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *_draw(seed),
    )
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offsets = tb.columns(batch.column("text"))
            for lo, hi in tb.chunks(offsets):
                base = offsets[lo]
                data, at = whole[base : offsets[hi]], offsets[lo : hi + 1] - base
                starts, ends = tb.runs(data, tb.SOLID, at)
                words = np.searchsorted(starts, at).tolist()
                few = {c: batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("_file", "_row", "doc_id", "h1", "h2", "h3", "h4")}
                out: list[list] = [[] for _ in names]
                for i, (f, r, d, h1, h2, h3, h4) in enumerate(zip(*few.values(), strict=True)):
                    a, b = int(at[i]), int(at[i + 1])
                    units = ends[words[i] : words[i + 1]]
                    if b > a and (not len(units) or units[-1] < b):
                        units = np.append(units, b)  # white space at the end
                    n = len(units)
                    text = data[a:b].tobytes()
                    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
                        form, spans, facts = "plain", [(a, b)], (None, None)
                    else:
                        form = "spm" if h4 % 100 < spm_rate else "psm"
                        x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
                        p, m = int(units[x - 1]) if x else a, int(units[y - 1]) if y else a
                        spans = [(a, p), (p, m), (m, b)]
                        facts = _characters(data[a:p]), _characters(data[p:m])
                    place = 0
                    for marker, part in FORMS[form]:
                        for j, (s, e) in enumerate(_cuts(*spans[part], units, size) or [(a, a)]):
                            piece = text[s - a : e - a] if j else marker + text[s - a : e - a]
                            first = (d, n, form, *facts) if not place else (d, None, None, None, None)
                            for column, v in zip(out, (f, r, *first, place, piece), strict=True):
                                column.append(v)
                            place += 1
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return rows.mapInArrow(cut, _PIECES)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, ROWS).columns], strict=True)


def _batched(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 8 * PIECE) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``size`` bytes of their last column."""
    held, held_bytes = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    for row in rows:
        held.append(row)
        held_bytes += 100 + len(row[-1] or b"")
        if held_bytes > size:
            yield batch()
            held, held_bytes = [], 0
    if held:
        yield batch()


def assemble(pieces: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document: facts, ``output_sha256`` and ``restored_sha256``.

    With ``texts`` also ``output`` and ``restored``, whose tasks hold one text at
    a time; without, memory is that of a piece.
    """
    part_names = [c.split()[0] for c in _PARTS.split(", ")]
    part_kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    result = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    result += ", output string, restored string" if texts else ""
    names = [c.split()[0] for c in result.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()] + [pa.string()] * (len(names) - 5)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """The output in order: its digest, and its pieces with the parts their markers name."""
        key = facts = digest = kept = None
        ahead: list[tuple[bytes, int]] = []
        for f, r, d, n, form, p, m, at, piece in _rows(batches):
            if at == 0:
                if facts:
                    yield (*key, *facts, digest.hexdigest(), _ENDS, 0, b"".join(kept) if texts else None)
                key, facts, digest, kept = (f, r), (d, n, form, p, m), hashlib.sha256(), []
                ahead, part = list(FORMS[form]), 0
            digest.update(piece)
            if texts:
                kept.append(piece)
            if ahead and piece.startswith(ahead[0][0]):
                marker, part = ahead.pop(0)
                piece = piece[len(marker) :]
            yield (*key, None, None, None, None, None, None, part, at, piece)
        if facts:
            yield (*key, *facts, digest.hexdigest(), _ENDS, 0, b"".join(kept) if texts else None)

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        digest, kept = hashlib.sha256(), []
        for _, _, d, n, form, p, m, written_digest, part, _, piece in _rows(batches):
            if part < _ENDS:
                digest.update(piece)
                if texts:
                    kept.append(piece)
                continue
            more = (piece.decode(), b"".join(kept).decode()) if texts else ()
            yield (d, n, form, p, m, written_digest, digest.hexdigest(), *more)
            digest, kept = hashlib.sha256(), []

    in_order = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "at")
    parts = in_order.mapInArrow(lambda b: _batched(written(b), part_names, part_kinds), _PARTS)
    return parts.sortWithinPartitions(*_KEY, "part", "at").mapInArrow(lambda b: _batched(read_back(b), names, kinds), result)
