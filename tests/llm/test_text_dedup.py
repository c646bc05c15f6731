"""Suffix-array dedup, line dedup and MinHash near-dedup against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from grantweave.llm import common, line_dedup, near_dedup, suffix_dedup
from grantweave.llm.suffix_array import suffix_array

SMALL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sample(seed=4, count=120):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gâmma", "delta", "漢字", "x", "epsilon-zeta", "eta", "Theta", "iota"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(n))

    passage, line = prose(14), "A line that many documents share, Ünïcode too"
    texts = []
    for i in range(count):
        kind = i % 6
        if kind == 0 or len(texts) < 6:
            texts.append(prose(rng.randrange(1, 60)))
        elif kind == 1:
            texts.append(rng.choice(texts))
        elif kind == 2:
            parts = rng.choice(texts).split(" ")
            parts[rng.randrange(len(parts))] = "changed" + str(i)
            texts.append(" ".join(parts))
        elif kind == 3:
            texts.append(prose(8) + " " + passage + prose(3))
        elif kind == 4:
            texts.append("\n".join([prose(3), "  " + line.upper() + "\t", prose(2), line, "", line.lower()]))
        else:
            texts.append(prose(2) + "\n" + line)
    texts += ["", None, "a" * 300, "a" * 299, "\n\n", "ab" * 200, "short", "\x00\x01" * 60, "\x00\x01" * 60]
    return list(enumerate(texts))


def shuffled(rows):
    rows = list(rows)
    random.Random(9).shuffle(rows)
    return rows


def test_suffix_array_is_the_order_of_suffixes():
    rng = random.Random(1)
    for _ in range(2000):
        text = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randrange(25))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    for text in ([1] * 500 + [0], [1, 2] * 300 + [0], [2, 1] * 300 + [0]):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def repeats(rows):
    seen, out = {}, {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        keep = bytearray(b"\1" * len(b))
        for k in range(len(b) - 49):
            if seen.setdefault(b[k : k + 50], i) < i:
                keep[k : k + 50] = b"\0" * 50
        rest = bytes(c for c, f in zip(b, keep) if f)
        out[i] = (len(b), len(b) - len(rest), sum(1 for z in bytes(keep).split(b"\1") if z), hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("seed", [4, 5])
def test_repeated_bytes_go(make, seed):
    rows = sample(seed)
    found = suffix_dedup.remove_repeats(make(shuffled(rows)).repartition(5)).withColumn("sha", F.sha2("kept", 256))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in found.collect()} == repeats(rows)
    assert {"lang", "rep", "text"} <= set(found.columns)


def test_repeated_bytes_odd_rows(make):
    text = "the same words over and over again, and then the same words once more"
    found = suffix_dedup.remove_repeats(make([(2, text), (2, text), (7, text), (None, text), (1, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0), (1, 0), (2, 0), (2, 0), (7, len(text))]
    assert suffix_dedup.remove_repeats(make([])).count() == 0


def broken_runs(seed, count=60):
    """Texts of long runs of one byte, broken by two or three others."""
    rng, rows = random.Random(seed), []
    for i in range(count):
        fill = rng.choice(["|", "\n", "0", "ab"])
        parts = [fill * rng.randrange(40, 90) + "".join(rng.choice("0123") for _ in range(rng.choice([2, 3]))) for _ in range(rng.randrange(1, 5))]
        rows.append((i, "".join(parts) + fill * rng.randrange(30, 80)))
    return rows


@pytest.mark.parametrize("rows", [
    [(1, "|" * 60 + "00" + "|" * 60), (2, "|" * 60 + "02" + "|" * 60)],
    [(1, "\n" * 60 + "00" + "\n" * 60), (2, "\n" * 60 + "13" + "\n" * 60)],
    broken_runs(1), broken_runs(2), broken_runs(3),
])
def test_segments_that_differ_inside_are_not_equal(make, rows):
    found = suffix_dedup.remove_repeats(make(shuffled(rows)).repartition(3)).withColumn("sha", F.sha2("kept", 256))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in found.collect()} == repeats(rows)


def lines(rows):
    first, holders = {}, {}
    for i, text in rows:
        for key in line_dedup.line_keys(text, 10):
            if key is not None:
                first[key] = min(first.get(key, i), i)
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, text in rows:
        parts = (text or "").split("\n")
        keys = [p.strip(" \t\n\v\f\r").encode().translate(SMALL) for p in parts]
        stay = [p for p, k in zip(parts, keys) if not (len(k.decode()) >= 10 and len(holders[k]) > 1 and first[k] < i)]
        out[i] = (len(parts), len(parts) - len(stay), "\n".join(stay))
    return out


@pytest.mark.parametrize("bits", [64 << 20, line_dedup.SEGMENTS])
def test_repeated_lines_go(make, monkeypatch, bits):
    """Also with filters of eight bits: more suspects, the same result."""
    monkeypatch.setattr(line_dedup, "MAX_FILTER_BYTES", bits)
    rows = sample()
    found = line_dedup.dedup_lines(make(shuffled(rows)).repartition(5)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in found} == lines(rows)


def test_repeated_lines_odd_rows(make):
    line = "one line of words"
    found = line_dedup.dedup_lines(make([(3, line), (3, line), (5, line + "\n" + line), (None, line), (4, None)]))
    assert sorted((r.doc_id or 0, r.n_dropped, r.text) for r in found.collect() if r.text is not None) == [(0, 0, line), (3, 0, line), (3, 0, line), (5, 2, "")]
    assert found.columns == ["doc_id", "text", "lang", "score", "kept", "id", "rep", "n_lines", "n_dropped"]
    assert line_dedup.dedup_lines(make([])).count() == 0


def shingle_sets(rows):
    out = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(SMALL))
        out[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    return out


def groups(sets):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def near_rows():
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(160):  # a chain of near copies, some of them far from the first
        words = base[:]
        for _ in range(rng.choice([0, 1, 2, 4, 6])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows + [(1000 + i, t) for i, t in sample()]


@pytest.mark.parametrize("cell", [8000, 20])
def test_near_copies_form_the_groups_of_brute_force(make, monkeypatch, cell):
    """Also with lists and families cut into chunks."""
    monkeypatch.setattr(near_dedup, "LIST_CELL", cell)
    monkeypatch.setattr(near_dedup, "FAMILY_CELL", cell)
    rows = near_rows()
    found = near_dedup.near_groups(make(shuffled(rows)).drop("kept").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == groups(shingle_sets(rows))


def test_stage_of_the_pipeline_takes_five_words(spark, make):
    """Against brute force, with copies that only sets of four words would link."""
    import corpus_pipeline

    rng = random.Random(6)
    rows = near_rows() + [(2000, " ".join(words := [f"v{rng.randrange(10**6)}" for _ in range(400)]))]
    rows.append((2001, " ".join("changed" + w if k % 40 == 20 else w for k, w in enumerate(words))))
    five = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(SMALL))
        five[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    four = shingle_sets(rows)
    assert groups(four)[2001][1:] == (2000, False) and groups(five)[2001][1:] == (2001, True)
    found = corpus_pipeline.drop_near_copies(spark, make(shuffled(rows)).repartition(3), "").collect()
    assert {r.doc_id for r in found} == {i for i, (_, _, kept) in groups(five).items() if kept}


def test_near_copies_odd_rows(make):
    text = "one two three four five six"
    rows = near_dedup.near_groups(make([(4, text), (4, text), (9, text.upper()), (None, text), (1, None), (2, " \t")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True), (1, 1, True), (2, 2, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    assert near_dedup.near_groups(make([])).count() == 0


def test_few_agreements_are_too_rare_to_matter():
    """Sets of similarity 0.8 agree in fewer than MATCHES of the coordinates once in a million at most."""
    from math import comb

    n = near_dedup.COORDINATES
    assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(near_dedup.MATCHES)) < 1e-6
    assert len(near_dedup.GROUPS) == near_dedup.MATCHES - 1  # so one group holds two of MATCHES agreements


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (200, 200), (None, 5)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(51)} | {100: 100, 101: 100, 103: 100}
    star = [(0, i) for i in range(1, 2000)] + [(i, i + 5000) for i in range(1, 2000)]
    found = common.components(spark.createDataFrame(star, "a long, b long"))
    assert found.agg(F.max("component"), F.count("*")).first() == (0, 3999)
