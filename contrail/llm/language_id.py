"""Language identification by unigram models over the pieces of a fixed public vocabulary.

A word's probability in a language is the sum over all its segmentations into
pieces of the product of the piece probabilities, by a forward pass over its
bytes, whole words of any length included: prefixes of long words are scaled as
they shrink. Piece probabilities are estimated by expectation-maximisation
(forward-backward) on words of labelled texts; longer words are learned from in parts. A text's words are independent,
so its evidence is the sum of its words' log-probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm import textbytes as tb

SAMPLE = 300  # most labelled documents of a language that its model is fitted on
LEARNED = 40  # bytes with the leading blank of the words that a model is fitted on; longer ones are learned in parts
SHORT = 28  # bytes with the leading blank of words whose probability needs no scaling
STEPS = 1024  # bytes of a long word whose pieces are looked up at a time
ROUNDS = 3
SMOOTH = 0.05
KNOWN = 150_000  # words whose probabilities a task remembers
UNKNOWN = "und"

_K = 0x100000001B3 | 1
_FILTER_BITS = 20


@dataclass
class Vocabulary:
    """Sorted hashes of the pieces and a bitmap that most other strings miss."""

    hashes: np.ndarray
    bitmap: np.ndarray
    longest: int  # bytes of the longest piece

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash's piece; the number of pieces where there is none."""
        out = np.full(h.shape, len(self.hashes), dtype=np.int32)
        near = np.flatnonzero(self.bitmap[(h >> np.uint64(64 - _FILTER_BITS)).ravel()])
        value = h.ravel()[near]
        at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
        good = self.hashes[at] == value
        out.ravel()[near[good]] = at[good]
        return out


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log, by language
    pieces: np.ndarray  # probabilities, one row a piece and a last row of zeros


def _string_hash(b: bytes) -> int:
    h = 0
    for x in b:
        h = (h * _K + int(tb._BYTES[x])) % 2**64
    return int(tb.mix(np.array([h ^ (len(b) << 56)], dtype=np.uint64))[0])


def vocabulary(path: str | None = None) -> Vocabulary:
    """Pieces of letters, lower-cased, with or without a leading blank, and all single bytes."""
    import base64

    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        tokens = [base64.b64decode(line.split()[0]) for line in lines]
    pieces = {bytes([b]) for b in range(256)}
    for token in tokens:
        low = token.lower()
        word = low[1:] if low.startswith(b" ") else low
        if word and all(tb.LETTERS[x] for x in word):
            pieces.add(low)
    hashes = np.unique(np.array([_string_hash(p) for p in pieces], dtype=np.uint64))
    bitmap = np.zeros(1 << _FILTER_BITS, dtype=bool)
    bitmap[hashes >> np.uint64(64 - _FILTER_BITS)] = True
    return Vocabulary(hashes, bitmap, max(map(len, pieces)))


def _segments(matrix: np.ndarray, vocab: Vocabulary) -> list[np.ndarray]:
    """For each piece length l, the piece numbers at every start: (words, n - l + 1)."""
    value = tb._BYTES[matrix]
    out, h = [], np.zeros_like(value)
    for size in range(1, min(vocab.longest, matrix.shape[1]) + 1):
        starts = matrix.shape[1] - size + 1
        h = h[:, :starts] * np.uint64(_K) + value[:, size - 1 : size - 1 + starts]
        out.append(vocab.find(tb.mix(h ^ np.uint64(size << 56))))
    return out


def _forward(segments: list[np.ndarray], pieces: np.ndarray, n: int) -> np.ndarray:
    """Probabilities of all prefixes: (n + 1, words, languages)."""
    alpha = np.zeros((n + 1, len(segments[0]), pieces.shape[1]))
    alpha[0] = 1
    for end in range(1, n + 1):
        for size in range(1, min(len(segments), end) + 1):
            number = segments[size - 1][:, end - size]
            hit = np.flatnonzero(number < len(pieces) - 1)
            if len(hit):
                alpha[end, hit] += alpha[end - size, hit] * pieces[number[hit]]
    return alpha


def _backward(segments: list[np.ndarray], pieces: np.ndarray, n: int) -> np.ndarray:
    beta = np.zeros((n + 1, len(segments[0]), pieces.shape[1]))
    beta[n] = 1
    for at in range(n - 1, -1, -1):
        for size in range(1, min(len(segments), n - at) + 1):
            number = segments[size - 1][:, at]
            hit = np.flatnonzero(number < len(pieces) - 1)
            if len(hit):
                beta[at, hit] += beta[at + size, hit] * pieces[number[hit]]
    return beta


def _cut(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words cut to LEARNED - 1 bytes: starts and ends, word by word in order."""
    most = LEARNED - 1
    times = -(-(ends - starts) // most)
    begin = np.repeat(starts, times)
    nth = np.arange(len(begin)) - np.repeat(np.cumsum(times) - times, times)
    begin = begin + nth * most
    return begin, np.minimum(begin + most, np.repeat(ends, times))


def _forward_scaled(matrix: np.ndarray, sizes: np.ndarray, vocab: Vocabulary, pieces: np.ndarray) -> np.ndarray:
    """log P of words of any length: of the first ``sizes`` bytes of each row of ``matrix``.

    Only the prefixes that a piece can still begin at are kept; every few bytes
    they are divided by the largest of them, and the logarithm is remembered.
    """
    words, n = matrix.shape
    longest, none = min(vocab.longest, n), len(pieces) - 1
    recent = np.zeros((longest, words, pieces.shape[1]))  # probabilities of the last prefixes, the newest first
    recent[0] = 1
    scale, out = np.zeros(recent.shape[1:]), np.zeros(recent.shape[1:])
    step = max(1, STEPS // words)
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        first = max(0, lo + 1 - longest)
        by_end = np.full((hi - lo, longest, words), none, dtype=np.int32)
        for size, found in enumerate(_segments(matrix[:, first:hi], vocab), 1):
            at = max(0, lo + 1 - size)
            if at + size <= hi:
                by_end[at + size - lo - 1 :, size - 1] = found[:, at - first :].T
        for end in range(lo + 1, hi + 1):
            newest = (recent * pieces[by_end[end - lo - 1]]).sum(axis=0)
            recent[1:] = recent[:-1].copy()
            recent[0] = newest
            done = np.flatnonzero(sizes == end)
            out[done] = np.log(newest[done]) + scale[done]
            if end % 8 == 0:
                peak = recent.max(axis=0)
                recent /= peak
                scale += np.log(peak)
    return out


def _log_probabilities(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocab: Vocabulary, pieces: np.ndarray) -> np.ndarray:
    """log P of whole words, a column for each language."""
    out = np.zeros((len(starts), pieces.shape[1]))
    sizes = ends - starts
    for size in np.unique(sizes[sizes < SHORT]):
        who = np.flatnonzero(sizes == size)
        for some in np.array_split(who, max(1, len(who) // 4000)):
            matrix = np.full((len(some), size + 1), 0x20, dtype=np.uint8)
            matrix[:, 1:] = tb.LOWER[data[starts[some][:, None] + np.arange(size)]]
            out[some] = np.log(_forward(_segments(matrix, vocab), pieces, int(size) + 1)[-1] + 1e-300)
    # Long words go with others of nearly their length; what stands behind a word's end does not count.
    long = np.flatnonzero(sizes >= SHORT)
    long = long[np.argsort(sizes[long], kind="stable")]
    lo = 0
    while lo < len(long):
        most = max(SHORT, int(sizes[long[lo]]) * 5 // 4)
        some = long[lo : lo + 64]
        some = some[sizes[some] <= most]
        width = int(sizes[some[-1]])
        matrix = np.full((len(some), width + 1), 0x20, dtype=np.uint8)
        for row, i in enumerate(some.tolist()):
            matrix[row, 1 : 1 + sizes[i]] = tb.LOWER[data[starts[i] : ends[i]]]
        out[some] = _forward_scaled(matrix, sizes[some] + 1, vocab, pieces)
        lo += len(some)
    return out


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "ignore"))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` texts of each non-null ``lang`` (by hash of doc_id).

    Every label is a language of the model, which holds a number for each of
    them and each piece. Of rows that share a doc_id and a label the least text
    is read. Rows without a label or id are not learned from; without any, the
    model knows no language.
    """
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"))
    counts = sorted(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["lang"])
    names = [r["lang"] for r in counts]
    vocab = vocabulary()
    if not names:
        return Model([], np.zeros(0), np.zeros((len(vocab.hashes) + 1, 0)))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= sample)
    # At most languages * sample ids, and one text of each.
    texts = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).join(
        F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"]
    )
    texts = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.columns(batch.column("text"))
            for lo, hi in tb.chunks(offsets):
                part = data[offsets[lo] : offsets[hi]]
                at = offsets[lo : hi + 1] - offsets[lo]
                s, e = _cut(*tb.runs(part, tb.LETTERS, at))
                lang = np.asarray(batch.column("lang").slice(lo, hi - lo).to_pylist(), dtype=object)
                of = lang[np.searchsorted(at, s, side="right") - 1] if len(s) else []
                raw = tb.LOWER[part].tobytes()
                word = [raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.string()), pa.array(word, pa.binary())], names=["lang", "word"])

    # The words of a bounded number of texts.
    words = texts.mapInArrow(run, "lang string, word binary").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).toPandas()
    index = {name: i for i, name in enumerate(names)}
    amount = np.zeros((0, len(names)))
    by_size: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}
    for size, group in words.groupby(words["word"].map(len)):
        distinct = sorted({bytes(w) for w in group["word"]})
        place = {w: i for i, w in enumerate(distinct)}
        amount = np.zeros((len(distinct), len(names)))
        rows = [place[bytes(w)] for w in group["word"]]
        np.add.at(amount, (rows, group["lang"].map(index).to_numpy()), group["n"].to_numpy())
        matrix = np.frombuffer(b"".join(b" " + w for w in distinct), np.uint8).reshape(len(distinct), size + 1)
        by_size[int(size)] = (_segments(matrix, vocab), amount)

    n = len(vocab.hashes)
    pieces = np.full((n + 1, len(names)), 1.0 / n)
    pieces[n] = 0
    for _ in range(ROUNDS):
        counts_ = np.full((n + 1, len(names)), SMOOTH)
        for size, (segments, amount) in by_size.items():
            alpha = _forward(segments, pieces, size + 1)
            beta = _backward(segments, pieces, size + 1)
            factor = amount / np.maximum(alpha[-1], 1e-300)
            for length, numbers in enumerate(segments, 1):
                for at in range(numbers.shape[1]):
                    number = numbers[:, at]
                    hit = np.flatnonzero(number < n)
                    if len(hit):
                        gain = alpha[at, hit] * pieces[number[hit]] * beta[at + length, hit] * factor[hit]
                        np.add.at(counts_, number[hit], gain)
        counts_[n] = 0
        pieces = counts_ / counts_.sum(axis=0)
    prior = np.log(np.array([r["n"] for r in counts], dtype=float))
    return Model(names, prior - np.log(np.exp(prior).sum()), pieces)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (its posterior probability).

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything when no language was learned. Ties go to the first language by
    name. Columns named like the results are replaced.
    """
    made = ["lang_pred", "score"]
    kept = [c for c in docs.columns if c not in made]
    names, prior = np.array([*model.languages, UNKNOWN], dtype=object), model.prior
    # One copy for all tasks; a row for each piece of the vocabulary, of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(model.pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, vocab = shared.value, vocabulary()
        known, values = np.zeros(0, np.uint64), np.zeros((0, len(prior)), np.float32)
        for batch in batches:
            data, offsets = tb.columns(batch.column(text))
            for lo, hi in tb.chunks(offsets):
                part = data[offsets[lo] : offsets[hi]]
                at = offsets[lo : hi + 1] - offsets[lo]
                n = hi - lo
                hashes, starts, ends, rows = tb.words(part, at, tb.LETTERS)
                best, value = np.full(n, len(prior)), np.zeros(n)
                if len(hashes) and len(prior):
                    distinct, one, back = np.unique(hashes, return_index=True, return_inverse=True)
                    spot = np.searchsorted(known, distinct)
                    old = np.zeros(len(distinct), bool) if not len(known) else known[np.minimum(spot, len(known) - 1)] == distinct
                    log = np.empty((len(distinct), len(prior)), np.float32)
                    log[old] = values[spot[old]]
                    new = np.flatnonzero(~old)
                    if len(new):
                        log[new] = _log_probabilities(part, starts[one[new]], ends[one[new]], vocab, pieces)
                        if len(known) + len(new) > KNOWN:
                            known, values = distinct, log
                        else:
                            known, values = np.concatenate([known, distinct[new]]), np.concatenate([values, log[new]])
                            order = np.argsort(known)
                            known, values = known[order], values[order]
                    sums = np.zeros((len(hashes) + 1, len(prior)))
                    np.cumsum(log[back], axis=0, out=sums[1:])
                    total = sums[rows[1:]] - sums[rows[:-1]] + prior
                    total -= total.max(axis=1, keepdims=True)
                    post = np.exp(total)
                    post /= post.sum(axis=1, keepdims=True)
                    lettered = rows[1:] > rows[:-1]
                    ascii_ = np.zeros(len(part) + 1, np.int64)
                    np.cumsum(tb.LETTERS[part] & (part < 128), out=ascii_[1:])
                    for i in np.flatnonzero(lettered & (ascii_[at[1:]] == ascii_[at[:-1]])):
                        lettered[i] = _has_letter(part[at[i] : at[i + 1]].tobytes())
                    best = np.where(lettered, post.argmax(axis=1), len(prior))
                    value = np.where(lettered, post.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, n) for c in kept] + [pa.array(names[best], pa.string()), pa.array(value, pa.float64())],
                    names=[*kept, *made],
                )

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes)
    return docs.select(*kept).mapInArrow(run, f"{schema}, lang_pred string, score double")
