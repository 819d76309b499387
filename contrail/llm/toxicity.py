"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence has the score ``sigmoid(bias + weights of its words and their beginnings)``, and a
document is toxic when any sentence is: its score is the noisy-or of them.
Only documents are labelled; the gradient of the noisy-or tells how much of a
document's label each sentence carries, and the sentence scores then locate
the offending places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import textbytes as tb

BITS = 18  # of the hashed vocabulary
SAMPLE = 1500  # most labelled documents of either class that the model is fitted on
LEAST_DOCS = 4  # a word counts when so many documents of the sample have it
STEPS = 150
RATE = 0.15
DECAY = 2e-5
START = -6.0  # first bias: most sentences are clean
THRESHOLD = 0.7

#: Word beginnings (bytes) that are features beside whole words, for inflected forms.
BEGINNINGS = (4, 5, 6)
#: Bytes that end a sentence.
ENDS = np.isin(np.arange(256), [0x0A, 0x21, 0x2E, 0x3F])


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(features, their sentences, word starts, sentences of words, documents of sentences).

    A feature is a slot of the hashed vocabulary and counts once a sentence; the
    pairs come in the order of the sentences.
    """
    hashes, starts, _, rows = tb.words(data, offsets, tb.LETTERS)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    mark = np.cumsum(ENDS[data])[starts] if len(starts) else np.zeros(0, np.int64)
    new = np.r_[True, (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])] if len(starts) else np.zeros(0, bool)
    sentence = np.cumsum(new) - 1
    pairs = []
    for h in (hashes, *[tb.words(data, offsets, tb.LETTERS, first=n)[0] for n in BEGINNINGS]):
        pairs.append((sentence << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64))[h != 0])
    pairs = np.unique(np.concatenate(pairs))
    return pairs & ((1 << BITS) - 1), pairs >> BITS, starts, sentence, doc[new]


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic) of the labelled documents with the smallest hashes, ``sample`` a class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)"
    )
    # A document with labels of both kinds says nothing.
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most")
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [known.filter(f"toxic = {t}").orderBy(*order).limit(sample).select("doc_id", "toxic") for t in (0, 1)]
    # At most 2 * sample ids.
    return docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` documents of either class; both are weighted to their true shares.

    Without documents of both classes the model scores everything 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.columns(batch.column("text"))
            for lo, hi in tb.chunks(offsets):
                slot, sentence, _, _, doc = _sentences(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                per = np.searchsorted(doc[sentence] if len(slot) else doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("toxic").slice(lo, hi - lo),
                        pa.array([slot[a:b].astype(np.int32).tobytes() for a, b in zip(per[:-1], per[1:], strict=True)], pa.binary()),
                        pa.array([sentence[a:b].astype(np.int32).tobytes() for a, b in zip(per[:-1], per[1:], strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "toxic", "slots", "sentences"],
                )

    got = training_rows(docs, labels, sample).mapInArrow(run, "doc_id long, toxic int, slots binary, sentences binary").collect()
    rows = sorted({r["doc_id"]: r for r in got}.values(), key=lambda r: r["doc_id"])  # at most 2 * sample
    y_all = np.array([r["toxic"] for r in rows])
    if len(set(y_all.tolist())) < 2:
        return Model(np.zeros(1 << BITS, np.float32), -np.inf)
    share = {r["toxic"]: r["n"] for r in labels.filter("toxic IN (0, 1)").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    slots, sent, y, weight, base = [], [], [], [], 0
    seen = np.zeros(1 << BITS, np.int32)
    for r in rows:
        x, s = np.frombuffer(r["slots"], np.int32), np.frombuffer(r["sentences"], np.int32)
        if not len(x):
            continue
        seen[np.unique(x)] += 1
        s = s - s[0]
        slots.append(x)
        sent.append(s + np.int32(base))
        y += [r["toxic"]] * (int(s[-1]) + 1)
        base += int(s[-1]) + 1
        weight.append((int(s[-1]) + 1, r["toxic"]))
    counts = np.array([w[0] for w in weight])
    label = np.array([w[1] for w in weight], dtype=float)
    slots, sent = np.concatenate(slots), np.concatenate(sent)
    del got, rows, r, x  # the driver's memory holds the sample once
    used = seen[slots] >= LEAST_DOCS
    slots, sent = slots[used], sent[used]
    words, slots = np.unique(slots, return_inverse=True)
    slots = slots.astype(np.int32)
    doc = np.repeat(np.arange(len(counts)), counts)
    n_class = np.array([(y_all == 0).sum(), (y_all == 1).sum()])
    of_class = np.array([share[0] / n_class[0], share[1] / n_class[1]])
    importance = of_class[label.astype(int)]
    importance /= importance.sum()

    w, bias = np.zeros(len(words)), START
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sent, weights=w[slots], minlength=base)
        soft = np.logaddexp(0, z)  # -log(1 - p)
        p = np.exp(z - soft)
        clean = np.bincount(doc, weights=soft, minlength=len(counts))  # -log P(no sentence is toxic)
        pull = np.where(label > 0, -1 / np.expm1(np.clip(clean, 1e-9, 500)), 1.0) * importance
        dz = pull[doc] * p
        grad = np.r_[np.bincount(slots, weights=dz[sent], minlength=len(words)) + DECAY * w, dz.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights = np.zeros(1 << BITS, np.float32)
    weights[words] = w
    return Model(weights, float(bias))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus score, predicted, and the most toxic sentence.

    ``sentence_start`` and ``sentence_end`` are UTF-8 byte offsets of that
    sentence's first word and of the end of its last one, ``sentence_score``
    its own score. Null, empty and wordless texts score 0 and have no sentence.
    Columns named like the results are replaced. Empty tables give no rows.
    """
    made = ["score", "predicted", "sentence_start", "sentence_end", "sentence_score", "sentences_flagged"]
    kept = [c for c in docs.columns if c not in made]
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.columns(batch.column("text"))
            for lo, hi in tb.chunks(offsets):
                part = data[offsets[lo] : offsets[hi]]
                at = offsets[lo : hi + 1] - offsets[lo]
                slot, of, starts, sentence, doc = _sentences(part, at)
                n = hi - lo
                out = {c: np.zeros(n) for c in ("score", "best")}
                where = np.full(n, -1)
                flagged = np.zeros(n, np.int64)
                first = np.searchsorted(sentence, np.arange(len(doc)))
                if len(doc) and np.isfinite(bias):
                    z = bias + np.bincount(of, weights=weights[slot], minlength=len(doc))
                    soft = np.logaddexp(0, z)
                    out["score"] = -np.expm1(-np.bincount(doc, weights=soft, minlength=n))
                    own = np.exp(z - soft)
                    flagged = np.bincount(doc, weights=own >= 0.5, minlength=n).astype(np.int64)
                    order = np.lexsort((np.arange(len(doc)), -own, doc))
                    lead = order[np.r_[True, doc[order][1:] != doc[order][:-1]]]
                    where[doc[lead]] = lead
                    out["best"][doc[lead]] = own[lead]
                has = where >= 0
                begin = np.zeros(n, np.int64)
                stop = np.zeros(n, np.int64)
                if has.any():
                    begin[has] = starts[first[where[has]]] - at[:-1][has]
                    # A sentence ends before the next one, at the end of its last word.
                    last = np.r_[first[1:], len(starts)][where[has]] - 1
                    bound = np.r_[starts[1:], len(part)][last]
                    tail = [int(x) for x in bound]
                    for i, d in enumerate(np.flatnonzero(has)):
                        end = min(tail[i], int(at[d + 1]))
                        gap = np.flatnonzero(~tb.LETTERS[part[starts[last[i]] : end]])
                        stop[d] = (int(starts[last[i]]) + (int(gap[0]) if len(gap) else end - int(starts[last[i]]))) - at[d]
                columns = [batch.column(c).slice(lo, n) for c in kept]
                value = np.clip(out["score"], 0, 1)
                columns += [
                    pa.array(value, pa.float64()), pa.array((value >= threshold).astype(np.int32), pa.int32()),
                    pa.array(begin, pa.int64(), mask=~has), pa.array(stop, pa.int64(), mask=~has),
                    pa.array(out["best"], pa.float64(), mask=~has), pa.array(flagged, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *made])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes)
    return docs.select(*kept).mapInArrow(
        run,
        f"{schema}, score double, predicted int, sentence_start long, sentence_end long, sentence_score double, sentences_flagged long",
    )
