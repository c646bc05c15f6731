"""Word vectors of the quality classifier against a plain count, and odd rows."""

import random

import numpy as np
import pytest

from grantweave.llm import common, quality


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return quality.units(data, np.array([0, len(data)]))[0]


def _index(h) -> np.ndarray:
    out = np.zeros(quality.WIDTH)
    places, signs = quality.index_entries(np.array([h], np.uint64))
    for p, s in zip(places[0], signs[0], strict=True):
        out[p] += s
    return out


def _plain_vectors(texts: list, corpus: list) -> np.ndarray:
    """Pooled vectors by loops over all tokens."""
    context: dict = {}
    for text in corpus:
        words = [int(h) for h in _hashes(text)[:, 0]]
        for k, w in enumerate(words):
            total = context.setdefault(w, np.zeros(quality.WIDTH))
            for j in (k - 1, k + 1):
                if 0 <= j < len(words):
                    total += _index(words[j])
    out = []
    for text in texts:
        three = _hashes(text)
        x = np.zeros(quality.OWN + quality.WIDTH + 2)
        for token in three:
            for k in range(3):
                x[k * quality.WIDTH : (k + 1) * quality.WIDTH] += _index(token[k])
            c = context.get(int(token[0]), np.zeros(quality.WIDTH))
            x[quality.OWN : -2] += np.rint(c * (quality.UNIT / (np.sqrt((c**2).sum()) or 1))) / quality.UNIT
        x[quality.OWN - 1] = sum(a[0] == b[0] for a, b in zip(three[1:], three[:-1], strict=True))
        x[:-2] /= max(len(three), 1)
        x[-2:] = np.log1p(len(three)), np.log1p(len({int(t[0]) for t in three}))
        out.append(x)
    return np.array(out)


def _texts(seed: int, count: int) -> list:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    texts = [" ".join(rng.choice([w, w.upper(), w + "!", "12-3"]) for w in rng.choices(words, k=rng.randrange(0, 40))) for _ in range(count)]
    return [*texts, None, "", " \t\n", "alone", "the same " * 4000, texts[0], texts[0]]


def _got(rows) -> dict:
    return {r.doc_id: np.frombuffer(bytes(r[quality._X]), np.float16).astype(float) for r in rows.collect()}


@pytest.mark.parametrize("parts", [1, 5])
def test_vectors_equal_a_plain_count(spark, make, parts):
    texts = _texts(parts, 40)
    docs = make(list(enumerate(texts))).repartition(parts)
    got = _got(quality.pooled(docs, docs, "text", ["doc_id"]))
    assert sorted(got) == list(range(len(texts)))
    np.testing.assert_allclose(np.array([got[k] for k in sorted(got)]), _plain_vectors(texts, texts), atol=2e-3, rtol=2e-3)


def test_vectors_do_not_depend_on_blocks(spark, make):
    rows = list(enumerate(_texts(3, 60)))
    one, many = (_got(quality.pooled(d, d, "text", ["doc_id"])) for d in (make(rows).coalesce(1), make(rows).repartition(9)))
    assert sorted(one) == sorted(many) and all((one[k] == many[k]).all() for k in one)


def test_other_documents_take_the_vectors_of_the_corpus(spark, make):
    corpus, texts = _texts(4, 30), [*_texts(5, 10), "words nobody wrote"]
    known, docs = make(list(enumerate(corpus))), make(list(enumerate(texts)))
    got = _got(quality.pooled(docs, known, "text", ["doc_id"]))
    np.testing.assert_allclose(np.array([got[k] for k in sorted(got)]), _plain_vectors(texts, corpus), atol=2e-3, rtol=2e-3)


def test_hot_words_and_many_words_have_own_vectors(spark, make):
    """Every word has its own vector: 20,000 rare ones around a word that all documents hold."""
    texts = [" ".join(["hot", *(f"w{i}x{j}" for j in range(40)), "hot"]) for i in range(500)]
    docs = make(list(enumerate(texts)))
    got = _got(quality.pooled(docs, docs, "text", ["doc_id"]))
    some = [0, 250, 499]
    np.testing.assert_allclose(np.array([got[k] for k in some]), _plain_vectors([texts[k] for k in some], texts), atol=2e-3, rtol=2e-3)


def test_odd_rows_and_names_in_quality(spark):
    rows = [(str(k), ("FREE!!! " if k % 3 == 0 else "calm prose ") * (k % 7 + 1), "kept", 1, b"x") for k in range(60)]
    rows += [(None, None, "kept", 1, b"x"), (None, "", None, None, None), ("7", rows[7][1], "kept", 2, None)]
    docs = spark.createDataFrame(rows, f"doc_id string, text string, score string, _id int, {quality._X} binary")
    labels = spark.createDataFrame([(str(k), int(k % 3 != 0), 5) for k in range(60)] + [("1", 0, 5), (None, 1, 5), ("2", None, 5)], "doc_id string, quality int, _id int")
    model = quality.learn(docs, labels)
    out = quality.score(docs, model)
    assert [c for c in out.columns if c != "score"] == ["doc_id", "text", "_id"] and dict(out.dtypes)["score"] == "double"
    got = out.collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == "7"}) == 1
    assert len({r.score for r in got if r.doc_id is None}) == 1
    again = {(r.doc_id, r.text): r.score for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    assert all(abs(again[r.doc_id, r.text] - r.score) < 1e-9 for r in got)
    none = docs.limit(0)
    assert quality.learn(none, labels) == 0.5 and quality.score(none, model).count() == 0
    assert common.written(quality.score(docs, 0.5)).count() == len(rows)
