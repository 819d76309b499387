"""Infilling, vector codes and byte-pair encoding against brute force and the public library."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import bpe, infill, vector_codes
from contrail.llm.scratch import ship_code

DOCS = "doc_id long, text string, form string, n string, ids string, _row string, piece string"
UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship_code(spark)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    parts = ["ab ", "don't", "\n", "  ", "12", "é", "!?", " word", "\t", "漢字 ", " ", "<|endoftext|>", "<|end", "'s", "'re", "'l", " '", "🙂"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))) for _ in range(120)]
    made += ["", None, " ", " \n\t ", "one", "has <P> inside", "ends <S", "<", "<M>", "x" * 3000 + " " + "é" * 2000, "a b  " * 900, "we'll 'tis it's''s"]
    return made + made[:3]


def frame(spark, texts):
    rows = [(i, t, "f", "n", "i", "r", "p") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *rows[:2], (None, "no id", *"fnirp"), (None, "no id", *"fnirp")], DOCS)


def infilled(doc_id, text):
    """Form, output and lengths by the definition."""
    units = UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size", [7, infill.PIECE])
def test_infilling_equals_its_definition(spark, texts, size):
    docs = frame(spark, texts)
    got = infill.assemble(infill.fim_pieces(docs, size=size), texts=True).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        text = r.text or ""
        n, form, p, m, out = infilled(r.doc_id, text)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
        want.append((r.doc_id, n, form, p, m, *digests, out, text))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    plain = infill.assemble(infill.fim_pieces(docs, size=size)).collect()
    assert sorted(map(repr, map(tuple, plain))) == sorted(repr(w[:7]) for w in want)


def test_infilling_takes_one_shuffle(spark, texts):
    number = ["_f", "_i"]
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("f").alias("_f"), F.col("id").alias("_i"))
    plan = infill.assemble(infill.fim_pieces(docs, number))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2
    assert infill.assemble(infill.fim_pieces(docs.limit(0), number)).count() == 0


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_ids_equal_the_library(spark, texts, library):
    docs = frame(spark, texts)
    got = bpe.decode_ids(bpe.encode_texts(docs)).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sorted(map(repr, map(tuple, bpe.encode_texts(docs, decoded="text").collect()))) == sorted(map(repr, want))
    assert bpe.encode_texts(docs.limit(0)).count() == 0


def test_classes_of_all_characters(library):
    every = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    random.Random(2).shuffle(every)
    some = ["".join(every[i : i + 300]) for i in range(0, len(every), 300)][::12]
    for text, ids in zip(some, bpe.vocabulary().encode(some, bpe.Cache()), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("block", "cache", "few"), [(50, 40, 1), (200, 1 << 20, 2), (1 << 20, 1 << 20, 10**9)])
def test_blocks_and_lists_change_nothing(monkeypatch, texts, library, block, cache, few):
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "CACHE", cache)
    monkeypatch.setattr(bpe, "FEW", few)
    given = [t or "" for t in texts]
    for text, ids in zip(given, bpe.vocabulary().encode(given, bpe.Cache()), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_ids_decode_like_the_library(library):
    rnd = np.random.default_rng(3)
    for _ in range(50):
        ids = rnd.integers(0, 50257, 40).tolist()
        assert bpe.vocabulary().decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)
    assert bpe.vocabulary().decode(np.array([99999, 64], "<u4").tobytes()) == "a"


def lloyd(rows, entries, rounds, parts, scale=1024):
    kept = [(i, lab, np.floor(scale * np.array(v, dtype=float)).astype(int)) for i, v, lab in rows if v and None not in v and np.isfinite(v).all()]
    size = [len(v) for *_, v in kept]
    d = max(sorted(set(size)), key=size.count)
    kept = [(i, lab, np.concatenate([v, np.zeros(-d % parts, int)])) for i, lab, v in kept if len(v) == d]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))[:entries]
    books = [np.array(b) for b in np.split(np.array([r[2] for r in first]), parts, axis=1)]
    cut = np.split(np.array([r[2] for r in kept]), parts, axis=1)

    def assign():
        far = [((c[:, None] - b[None]) ** 2).sum(-1) for c, b in zip(cut, books, strict=True)]
        return [f.argmin(1) for f in far], sum(f.min(1) for f in far)

    for _ in range(rounds):
        codes, _ = assign()
        for p in range(parts):
            for e in set(codes[p].tolist()):
                mine = cut[p][codes[p] == e]
                books[p][e] = mine.sum(0) // len(mine)
    codes, error = assign()
    total = {}
    for (_, lab, _), e in zip(kept, error, strict=True):
        total[lab] = total.get(lab, 0) + int(e)
    digest = vector_codes.codebooks_sha256(books)
    return [
        (i, lab, "".join(f"{codes[p][j]:02x}" for p in range(parts)), int(error[j]), total[lab], digest) for j, (i, lab, _) in enumerate(kept)
    ]


@pytest.mark.parametrize(("width", "entries", "spread"), [(8, 32, 1.0), (6, 200, 0.01), (2, 9, 0.002)])
def test_codes_equal_brute_force(spark, width, entries, spread, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 64)
    rng = np.random.default_rng(width)
    centres = rng.normal(size=(5, width))
    made = [(i, [float(x) for x in centres[i % 5] + spread * rng.normal(size=width)], [None, 0, 1, 7][i % 4]) for i in range(170)]
    made += [(500 + i, made[3][1], 7) for i in range(90)]  # a group of copies
    made += [(900, None, 1), (901, [float("nan")] * width, 1), (902, [None] * width, 1), (903, [], 1), (904, [1.0], 1), (None, made[0][1], None), (7, made[7][1], 3)]
    made += [(905, [float("inf")] * width, 0), (906, [0.0] * width, 0)]
    df = spark.createDataFrame([(i, v, lab, "c", "e") for i, v, lab in made], "vec_id long, embedding array<double>, label int, code string, error string")
    got = vector_codes.compress(df.repartition(3), entries=entries, rounds=3).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, lloyd(made, entries, 3, 4)))


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(df).count() == vector_codes.compress(df.limit(0)).count() == 0


def test_trees_assign_whole_ranges():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (12, 6))
    points, weights = np.unique(np.repeat(centres, 200, axis=0) + rng.integers(-9, 9, (2400, 6)), axis=0, return_counts=True)
    tree = vector_codes.CoverTree(points, weights)
    for at in range(len(tree.centre)):
        below = points[tree.order[tree.lo[at] : tree.hi[at]]]
        far = np.sqrt(((below - points[tree.centre[at]]) ** 2).sum(1))
        assert far.max() == pytest.approx(tree.radius[at])
        kids = range(tree.child_lo[at], tree.child_hi[at])
        assert sum(tree.hi[k] - tree.lo[k] for k in kids) in (0, len(below))
        heads = points[tree.centre[list(kids)]] if kids else points[:0]
        assert all(((heads[i] - heads[j]) ** 2).sum() > (tree.radius[at] / 2) ** 2 for i in range(len(heads)) for j in range(i))
    chosen, counts, sums, compared = tree.assign(centres)
    assert compared < len(points) / 10
    want = ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
    assert (chosen == want).all() and (counts == np.bincount(want, weights, 12)).all()
    assert all((sums[e] == (points[want == e] * weights[want == e][:, None]).sum(0)).all() for e in range(12))


def test_large_numbers_stay_exact():
    a, b = np.array([[2**26, -(2**26)]]), np.array([[2**26 - 1, -(2**26) + 3], [-(2**26), 2**26]])
    assert vector_codes.squared(a, b).tolist() == [[10, 2 * 2**54]]
