"""Lexical search, vector codes and source mixing against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantweave.llm import lexical_search, mixing, vector_codes

SMALL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().translate(SMALL))


def ranked(docs, items, best=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    total, df = sum(n for *_, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * len(held)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:best])]
    return out


def texts(seed, count):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["Ünïcode", "漢字", "The", "tHE", "a1"]
    rows = []
    for i in range(count):
        if i % 7 == 3 and rows:
            rows.append((i, rng.choice(rows)[1]))
        else:
            rows.append((i, rng.choice([" ", "-", "\n", "_"]).join(rng.choice(words) for _ in range(rng.randrange(60)))))
    return rows + [(count, None), (count + 1, ""), (count + 2, "..."), (None, "w1 w2 the"), (None, None), (5, "w1 the the"), (5, "w1 the the")]


ITEM = "item_id long, text string, score string, rank string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "s", "r") for i, t in rows], ITEM)


def found(df):
    rows = [(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("shard", [1, 300, 8 << 20])
def test_search_equals_brute_force(spark, make, monkeypatch, shard):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(lexical_search.common, "PIECE_BYTES", min(shard, 2 << 20))
    docs = texts(1, 300)
    items = [(i, t) for i, t in texts(2, 25) if i is not None]
    items += [(100, "w1 w1 w1 the"), (100, "w2"), (None, "w1 the"), (102, "never seen"), (103, None)]
    rows = make(docs).repartition(3)
    got = found(lexical_search.search(rows, items_of(spark, items)))
    assert got == sorted(ranked(docs, items), key=repr)


def test_search_with_queries_in_several_blocks(spark, make, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 400)
    docs, items = texts(3, 80), [(i, t) for i, t in texts(4, 12) if i is not None]
    assert found(lexical_search.search(make(docs), items_of(spark, items))) == sorted(ranked(docs, items), key=repr)


def test_search_in_empty_tables(spark, make):
    items = items_of(spark, [(1, "w1")])
    for docs, asked in ((make([]), items), (make([(1, "w1")]), items_of(spark, [])), (make([(1, None), (2, "")]), items)):
        df = lexical_search.search(docs, asked)
        assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.count() == 0


def test_search_with_text_ids_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "WINDOW_BYTES", 64)
    rng = random.Random(5)
    docs = [(f"d{i}", " ".join(f"t{rng.randrange(50)}" for _ in range(rng.choice([3, 4000])))) for i in range(40)]
    docs += [("joined", "x" * 5000 + " t1"), ("d0", "漢" * 3000 + "t2")]
    items = [(1, "t1 t2 t3"), (2, "x" * 5000), (3, "t49 t48 t48")]
    rows = spark.createDataFrame(docs, "doc_id string, text string")
    got = found(lexical_search.search(rows, items_of(spark, items)))
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    want = ranked([(n, t) for n, (_, t) in enumerate(docs)], items, best=len(docs))
    assert {(r[0], r[3]) for r in got} <= {(w[0], w[3]) for w in want}
    for item, _ in items:
        best = sorted(((-w[3], docs[w[2]][0]) for w in want if w[0] == item))[:10]
        assert [(-r[3], r[2]) for r in sorted(got, key=lambda r: r[1]) if r[0] == item] == best
    assert len(held) == len(docs)


def test_accumulators_stop_but_lose_no_document():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, size = int(rng.integers(1, 40)), int(rng.integers(1, 8))
        counts = rng.integers(1, n + 1, size)
        places = np.concatenate([np.sort(rng.choice(n, c, replace=False)) for c in counts])
        added = rng.integers(0, rng.choice([3, 1000]), len(places))
        shard = lexical_search.Shard(n, np.arange(size), counts, places, added)
        query = [(int(t), int(rng.integers(1, 3))) for t in rng.permutation(size)]
        k, floor = int(rng.integers(1, 5)), int(rng.choice([0, 0, 500]))
        docs, scores = shard.best(query, k, floor)
        whole = np.zeros(n, np.int64)
        for t, times in query:
            a, b = shard.of[t]
            whole[places[a:b]] += times * added[a:b]
        kth = np.sort(whole)[::-1][min(k, n) - 1] if n >= k else 0
        want = np.flatnonzero(whole >= max(kth, floor, 1))
        assert set(want) <= set(docs.tolist()) and (whole[docs] == scores).all()


def test_terms_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical_search.common, "mix", lambda h: h % np.uint64(3))
    known = lexical_search.Vocabulary([b"ab", b"ba", b"c", b"abc"])
    low = np.frombuffer(b"ab ba c abc cab b", np.uint8)
    starts, ends = np.array([0, 3, 6, 8, 12, 16]), np.array([2, 5, 7, 11, 15, 17])
    got = [known.terms[t] if t >= 0 else None for t in known.find(low, starts, ends)]
    assert got == [b"ab", b"ba", b"c", b"abc", None, None]


def coded(rows, parts=8, entries=16, rounds=6):
    """vec_id, code, error, label_error by comparing all with all, and the digest."""
    kept = [(i, v, g) for i, v, g in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    cut = [np.array_split(np.array([math.floor(4096 * x) for x in v], dtype=object), parts) for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest():
        out = []
        for c in cut:
            gaps = [[sum((x - y) ** 2 for x, y in zip(c[p], b, strict=True)) for b in books[p]] for p in range(parts)]
            out.append([(min(range(len(g)), key=lambda e: (g[e], e)), min(g)) for g in gaps])
        return out

    for _ in range(rounds):
        own = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(cut)) if own[i][p][0] == e]
                if mine:
                    books[p][e] = sum(mine[1:], mine[0]) // len(mine)
    own = nearest()
    text = ",".join(str(int(x)) for b in books for e in b for x in e)
    errors = [int(sum(d for _, d in o)) for o in own]
    by_label = defaultdict(int)
    for (_, _, g), e in zip(kept, errors, strict=True):
        by_label[g] += e
    codes = ["".join(f"{e:02x}" for e, _ in o) for o in own]
    result = [(r[0], c, e, by_label[r[2]]) for r, c, e in zip(kept, codes, errors, strict=True)]
    return result, hashlib.sha256(text.encode()).hexdigest()


VEC = "vec_id long, embedding array<double>, label int, error string, _parts string, x string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, g, "e", "p", "x") for i, v, g in rows], VEC)


def vectors(seed, count, width):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(7)]
    rows = []
    for i in range(count):
        if i % 5 == 2 and rows:
            v = rng.choice(rows)[1]
        elif i % 11 == 4:
            v = [float(rng.choice([0, 0, 1, -1])) for _ in range(width)]
        else:
            v = [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]
        rows.append((i, v, rng.choice([None, 1, 2])))
    return rows


ODD = [(900, None, 1), (901, [], 1), (902, [None] * 16, 1), (903, [float("nan")] * 16, 2), (904, [1.0] * 15 + [float("inf")], None)]


@pytest.mark.parametrize("share", [0.0, 0.25, 2.0])
@pytest.mark.parametrize("width, count", [(16, 250), (11, 90), (3, 60)])
def test_codes_equal_brute_force(spark, monkeypatch, width, count, share):
    monkeypatch.setattr(vector_codes, "REANCHOR", share)
    rows = vectors(width, count, width)
    want, digest = coded(rows)
    odd = [r for r in ODD if not r[1] or len(r[1]) == width] + [(905, [0.5] * (width + 1), 1)]
    df, books = vector_codes.compress(vectors_of(spark, rows[::-1] + odd).repartition(3))
    assert df.columns == ["vec_id", "label", "x", "code", "error", "label_error"]
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in df.collect()) == sorted(want)
    assert books.digest() == digest


def test_codes_of_few_repeated_and_no_vectors(spark):
    same = [(1, [0.5] * 8, 1)] * 3 + [(2, [-0.25] * 8, None), (None, [0.125] * 8, 2)]
    want, digest = coded(same)
    df, books = vector_codes.compress(vectors_of(spark, same))
    assert sorted(map(repr, want)) == sorted(repr((r.vec_id, r.code, r.error, r.label_error)) for r in df.collect())
    assert books.digest() == digest
    for rows in ([], [(1, None, 1), (2, [None], 2)]):
        df, books = vector_codes.compress(vectors_of(spark, rows))
        assert books is None and df.count() == 0 and df.columns == ["vec_id", "label", "x", "code", "error", "label_error"]


def test_vectors_too_large_for_64_bits_are_dropped(spark):
    rows = [(1, [1e30] * 8, 1), (2, [0.5] * 8, 1), (3, [-3.4e38] * 8, 1), (4, [1000.0] * 8, 1)]
    df, books = vector_codes.compress(vectors_of(spark, rows))
    want, digest = coded([rows[1], rows[3]])
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in df.collect()) == sorted(want)
    assert books.digest() == digest


def test_balls_leave_the_nearest_entry_as_it_is():
    rng = np.random.default_rng(7)
    for _ in range(200):
        book = rng.integers(-9, 9, (int(rng.integers(1, 17)), int(rng.integers(1, 4))))
        parts = rng.integers(-12, 12, (60, book.shape[1]))
        gaps = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
        anchors = rng.integers(0, len(book), 60)
        radii = [math.isqrt(int(max(gaps[anchors == e, e], default=0))) + 1 for e in range(len(book))]
        for bound in (radii, [None] * len(book)):
            balls = [vector_codes.Ball(book, e, bound[e]) for e in range(len(book))]
            best, least = vector_codes.nearest(parts, anchors, book, balls)
            assert (best == gaps.argmin(axis=1)).all() and (least == gaps.min(axis=1)).all()


def filled(sizes, weights, share, epochs):
    """Targets by bisection on the water level."""
    total, low, high = share * sum(sizes), 0.0, 1e15
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(epochs * s, w * mid) for s, w in zip(sizes, weights, strict=True)) < total else (low, mid)
    return [min(epochs * s, w * low) for s, w in zip(sizes, weights, strict=True)]


DOC = "doc_id long, source string, text string, size string, _edge string, lang string"


def mixed_docs(seed, count, sources):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = rng.choice(sources) if rng.random() < 0.6 else sources[0]
        rows.append((i, source, " ".join("w" * rng.randrange(1, 4) for _ in range(int(rng.paretovariate(0.8)) % 500))))
    return rows


@pytest.mark.parametrize("share, epochs", [(1.5, 2), (0.4, 2), (2.9, 3), (5.0, 2)])
def test_mix_equals_brute_force(spark, share, epochs):
    rows = mixed_docs(3, 400, ["é", "a", "b", None, "B", "\U0001f600", "￿"])
    rows += [(None, "a", "null id one"), (None, "a", "null id two words"), (7, "b", None), (7, "b", ""), (1000, "empty", None)]
    rows += [(2000, "copies", "ten words " * 5)] * 40
    docs = spark.createDataFrame([(*r, "s", "e", "en") for r in rows], DOC).repartition(3)
    df = mixing.mix(docs, share=share, epochs=epochs)
    got = df.collect()
    assert df.columns == ["doc_id", "source", "text", "_edge", "lang", "size", "source_size", "target", "whole", "part", "taken"] and len(got) == len(rows)
    words = Counter()
    for _, s, t in rows:
        words[s] += len((t or "").split())
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(order, filled([words[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], share, epochs), strict=True))
    taken = Counter()
    for r in got:
        assert r["size"] == len((r.text or "").split()) and r.source_size == words[r.source]
        assert r.target == pytest.approx(targets[r.source], abs=1e-6)
        assert r.taken == r["size"] * r.whole + r.part and 0 <= r.part <= r["size"] and r.taken <= epochs * r["size"]
        taken[r.source] += r.taken
    for s in order:
        ties = 40 if s == "copies" else 1
        assert targets[s] - ties - 1e-6 <= taken[s] <= targets[s] + 1e-6
    again = mixing.mix(docs.repartition(5), share=share, epochs=epochs).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_seed_and_repetitions(spark):
    docs = spark.createDataFrame([(*r, "s", "e", "en") for r in mixed_docs(5, 120, ["a", "b", "c"])], DOC)
    one, two = (mixing.mix(docs, seed=s) for s in ("one", "two"))
    assert {(r.doc_id, r.taken) for r in one.collect()} != {(r.doc_id, r.taken) for r in two.collect()}
    rows = mixing.repeated(one).withColumn("n", mixing.size_of(F.col("text")))
    sums = {r.source: r.n for r in rows.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    assert sums == {r.source: r.n for r in one.groupBy("source").agg(F.sum("taken").alias("n")).collect()}


def test_mix_of_empty_and_wordless_tables(spark):
    for rows in ([], [(1, None, None), (2, "a", " \t")]):
        df = mixing.mix(spark.createDataFrame([(*r, "s", "e", "en") for r in rows], DOC))
        assert [(r["size"], r.target, r.taken) for r in df.collect()] == [(0, 0.0, 0)] * len(rows)


def test_mix_uses_built_in_functions_alone(spark, make):
    docs = spark.createDataFrame([(*r, "s", "e", "en") for r in mixed_docs(5, 50, ["a", "b"])], DOC)
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
