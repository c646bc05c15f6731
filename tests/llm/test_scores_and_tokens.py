"""Decontamination, toxicity, embeddings, language model, URL filter, BPE, quality and the pipeline."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from check_queries import TABLES, rows_of
from grantweave.llm import bpe, common, decontaminate, embedding_dedup, lm_scoring, quality, queries, toxicity, url_filter

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path(bpe.DEFAULT_RANKS)
SMALL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


# ------------------------------------------------------------ decontamination

ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (2, "rare words"), (3, None), (4, "!!"), (10, "two THREE four five six seven eight nine ten eleven"), (2, "rare words")]
TEXTS = [
    (1, "zero one, two three four five six seven eight nine ten eleven twelve"), (2, "one two three four five six seven eight nine ten"),
    (3, "Rare  WORDS rare words; and rare\nwords"), (4, None), (5, ""), (6, "rare"), (7, "one two three four five six seven eight nine"),
    (8, "rare"), (9, "words"), (None, "rare words"), (2, "one two three four five six seven eight nine ten"), (11, "a " * 5000 + "rare words"),
]


def contaminated(text, items):
    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(SMALL))

    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            p = w[k : k + 10]
            for i in range(len(own) - len(p) + 1):
                if own[i : i + len(p)] == p:
                    hit |= set(range(i, i + len(p)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontamination(spark, make, monkeypatch, block):
    """Also with the benchmark in several blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate.decontaminate(make(TEXTS).withColumn("items", F.lit("x")), items).collect()
    got = sorted((r.text or "", r.n_words, r.n_hit, tuple(r.items)) for r in rows)
    assert got == sorted((t or "", n, h, tuple(i)) for _, t in TEXTS for n, h, i in [contaminated(t, ITEMS)])
    clean = {r.doc_id: r.clean_text for r in rows}
    assert clean[1] == "zero  twelve" and clean[3] == "; and " and clean[4] is None and clean[6] == "rare"
    assert decontaminate.decontaminate(make([]), items).count() == 0
    assert decontaminate.decontaminate(make(TEXTS), items.limit(0)).where("n_hit > 0").count() == 0


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(1, 4, 300), [0], rng.integers(1, 4, 40), [0]])
    index = decontaminate.FMIndex(text, 4)
    phrases = [text[k : k + n] for k, n in ((3, 5), (10, 2), (302, 7), (0, 1))] + [np.array([3] * 12)]
    rows = np.zeros((len(phrases), 12), np.int64)
    for row, p in zip(rows, phrases):
        row[12 - len(p) :] = p
    low, high = index.search(rows, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high):
        want = [i for i in range(len(text) - len(p) + 1) if (text[i : i + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


# ------------------------------------------------------------------ toxicity


def test_grammar_marks_clauses():
    lexicon = toxicity.Lexicon([(0, b"moron", 2.0), (4, b"scumbag"[:4], 3.0)])

    def kinds(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return dict(zip(toxicity.KINDS, toxicity.clause_sums(data, np.array([0, len(data)]), lexicon)[0].tolist()))

    assert kinds("what a moron")["plain"] == 2 and kinds("you moron")["targeted"] == 2
    assert kinds("not a moron")["negated"] == 2 and kinds("she said: moron")["plain"] == 2  # a colon ends the clause
    assert kinds("she said a moron came")["reported"] == 2 and kinds("scummy SCUMBAGS")["plain"] == 6
    assert kinds("kill you")["weak threat"] == 1 and kinds("you I kill")["threat"] == 1 and sum(kinds("a fine day").values()) == 0


def toxic_rows(count=400):
    rng = random.Random(6)
    words = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(count):
        text = [rng.choice(words) for _ in range(40)]
        if i % 5 == 0:
            text[rng.randrange(40)] = rng.choice(["vilegit", "grobfoo", "grobbar" + chr(97 + i % 20), "nasty"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_toxicity_learns_words_and_stems(spark, make):
    rows, labels = toxic_rows()
    train = spark.createDataFrame([x for x in labels if x[0] < 300], "doc_id long, toxic int")
    docs = make(rows + [(None, None), (1000, ""), (1001, "!?"), (5, dict(rows)[5])])
    scored = toxicity.score(docs, toxicity.learn(docs, train)).collect()
    got = {r.doc_id: r.score for r in scored}
    held = [(i, y) for i, y in labels if i >= 300]
    assert sum((got[i] >= 0.5) == bool(y) for i, y in held) >= 0.97 * len(held)
    assert got[1000] == got[1001] == got[None] < 0.5 and len(scored) == len(rows) + 4
    one_class = toxicity.learn(docs, train.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, one_class).collect()} == {0.0}
    assert toxicity.score(make([]), toxicity.learn(docs, train)).count() == 0


def test_form_counts_hold_each_form_once(monkeypatch):
    rng = random.Random(7)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(3000)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": pa.array([int(i % 4 == 0) for i in range(3000)], pa.int32())})
    want = collections.defaultdict(lambda: [0, 0])
    for i, text in enumerate(texts):
        for form in {(n, w[:n] if n else w) for w in text.split() for n in toxicity.LENGTHS if len(w) >= n}:
            want[form][i % 4 > 0] += 1
    batches = [batch.slice(at, 50) for at in range(0, 3000, 50)]
    monkeypatch.setattr(toxicity, "FOLD", 2000)
    tracemalloc.start()
    got, = toxicity._counts(iter(batches), "text")
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    forms = {int(toxicity._form(np.array([toxicity.hash_of(w.encode())], np.uint64), n)[0]): c for (n, w), c in want.items()}
    pairs = zip(got["form"].to_numpy().view(np.uint64).tolist(), got["toxic"].to_pylist(), got["clean"].to_pylist(), strict=True)
    assert {f: [t, c] for f, t, c in pairs} == forms
    assert most < 4e6  # 31.7 MB when all texts' forms were held to the end


# ---------------------------------------------------------------- embeddings


def vectors(count=300, width=24):
    rng = np.random.default_rng(8)
    rows = [rng.normal(size=width) for _ in range(count)]
    for k in range(80):  # a chain whose ends are far apart, and a cloud
        rows.append(rows[-1] + rng.normal(size=width) * 0.2 if k < 40 else rows[0] + rng.normal(size=width) * 0.08)
    rows += [rows[3] * 2, rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("cell", [1500, 12])
def test_embedding_links_equal_brute_force(spark, monkeypatch, cell):
    """All links, so recall is 1 here; also with filters cut into chunks."""
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    rows = vectors()
    n = len(rows)
    unit = np.array([v / np.linalg.norm(v) for v in rows])
    near = unit @ unit.T >= 0.95
    label = np.arange(n)
    for _ in range(n):
        label = np.where(near, label[None, :], n).min(axis=1)
    table = [(i, v.tolist(), "x") for i, v in enumerate(rows)] + [(900, None, "x"), (901, [0.0] * 24, "x"), (902, [float("nan")] * 24, "x"), (903, [], "x"), (None, rows[0].tolist(), "x"), (904, [1.0, None], "x"), (905, [1.0, 0.0], "x")]
    random.Random(3).shuffle(table)
    found = embedding_dedup.near_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>, unit string").repartition(3)).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert {i: got[i] for i in range(n)} == {i: (int(near[i].sum()) - 1, int(label[i]), bool(label[i] == i)) for i in range(n)}
    assert all(got[i] == (0, i, True) for i in range(900, 906)) and got[None] == (0, None, True)
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("count", [10_000, 3_000_000])
def test_few_links_are_lost_at_every_size(count):
    """Pairs at the least cosine share a filter, however many vectors there are."""
    rng = np.random.default_rng(77)
    a, b = (embedding_dedup._units(rng.normal(size=(1000, 64))) for _ in range(2))
    b = embedding_dedup._units(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    code = embedding_dedup.ProductCode(64, *embedding_dedup.filters_needed(64, count, 0.95))
    assert sum(not np.intersect1d(code.decode(x), code.decode(y)).size for x, y in zip(a, b)) <= 10


# ------------------------------------------------------------- language model


def test_scores_of_the_language_model(make):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["The", "cat", "sat", "on", "mat\n", f"w{rng.randrange(99)}"]) for _ in range(rng.randrange(80)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\r\n"), (None, "the cat"), (3, rows[3][1])]
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10 == 0}
    scored = lm_scoring.score(make(rows), common.in_fold("doc_id", 10) == 0).collect()
    tokens = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(SMALL)) + [b"\n"]) for i, t in rows]
    counts = collections.Counter(w for i, ws in tokens if i not in held for w in ws)
    n, below = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    want = sorted((i or -1, i in held, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.1) / below) for w in ws), 6)) for i, ws in tokens)
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored) == want
    assert all(r.score < 0 for r in scored)
    assert sum(r.score for r in scored if r.held_out) > sum(r.base_score for r in scored if r.held_out)
    assert lm_scoring.score(make([]), F.lit(False)).count() == 0
    assert [r.n_known for r in lm_scoring.score(make([(1, "a b")]), F.lit(True)).collect()] == [0]


def test_log_frequency_filter_keeps_levels():
    h = common.mix(np.arange(1, 5001, dtype=np.uint64))
    level = np.array([2, 3, 4, 9, 17] * 1000, np.uint8)
    parts = {}
    for r, (own, q) in common.packed(lm_scoring._range(h), lm_scoring.RANGES, h, level):
        parts[r] = lm_scoring.LogFrequencyFilter.part(lm_scoring._short(own), q, 2)
    model = lm_scoring.LogFrequencyFilter(2, parts)
    estimate = 1.5 * 2.0 ** (level.astype(int) - 1) - 0.5
    assert (model.counts(h) >= estimate).all() and (model.counts(h) == estimate).mean() > 0.9
    assert (model.counts(common.mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))) > 0).mean() < 0.1


def test_every_count_from_one_is_held(make, monkeypatch):
    """Scores equal those of quantised counts, also of n-grams seen once and with many buckets."""
    monkeypatch.setattr(lm_scoring, "BITS_PER_ENTRY", 400)  # no false hits
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 50)
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(40))) for i in range(60)] + [(60, "once in a lifetime"), (61, "once in a lifetime"), (62, "never seen words")]
    held = {3, 61, 62}
    scored = lm_scoring.score(make(rows), F.col("doc_id").isin(held)).collect()
    single, double = collections.Counter(), collections.Counter()
    for i, t in rows:
        if i not in held:
            words = [None, *t.split(), None]
            single.update(words[1:])
            double.update(zip(words, words[1:]))
    below = sum(single.values()) + 0.1 * (len(single) + 1)

    def level(c):
        return 1.5 * 2 ** (c.bit_length() - 1) - 0.5 if c else 0.0

    def prob(a, b):
        own, history = (level(single[b]) + 0.1) / below, level(single[a])
        return min(1.0, 0.5 * own + 0.5 * min(level(double[a, b]), history) / max(history, 1) if history else own)

    want = {i: sum(math.log10(prob(a, b)) for a, b in zip([None, *t.split()], [*t.split(), None])) for i, t in rows}
    assert {r.doc_id: round(r.score, 6) for r in scored} == {i: round(x, 6) for i, x in want.items()}


# ----------------------------------------------------------------- URL filter


def test_rules_and_templates(spark):
    urls = [
        "http://WWW.Example.com/en/1?x", "https://a.example.com/en/1", "http://b.www.example.com/en/", "http://x.net/es/5#t", "http://x.net/en/1", "nourl", None, "ftp://com/",
        "http://examplecom/en/1", "http://h.org", "a://b://c/d", "http://h.org?x=/y",
    ]
    found = url_filter.judged(spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, share string")).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in sorted(found, key=lambda r: r.page_id)] == [
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("a.example.com", "/en/1", "example.com/en/", "block"), ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("x.net", "/es/5", "net/es/", "block"), ("x.net", "/en/1", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("com", "/", "com/", "allow"),
        ("examplecom", "/en/1", None, "allow"), ("h.org", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("h.org", "", None, "allow"),
    ]
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_templates_reject_by_purity(spark):
    rules = [("block", "h.org", "/ads/1"), ("allow", "h.org", "/news/1")]
    pages = [f"http://h.org/{kind}/{n}/{n * 7}" for kind in ("ads", "news") for n in range(100, 260)] + ["http://h.org/other/5"]
    found = url_filter.judged(spark.createDataFrame([(u,) for u in pages], "url string"), rules=rules).collect()
    by = collections.Counter((r.path.split("/")[1], r.verdict) for r in found if r.rule is None)
    assert by == {("ads", "block"): 60, ("news", "allow"): 60, ("other", "allow"): 1}


def shares_by_hand(pages):
    """Shares of (host, path) from [(host, path, verdict)], one node after another."""
    strength, prior = url_filter.STRENGTH, url_filter.PRIOR

    def counts(rows):
        return sum(v is not None for *_, v in rows), sum(v == "block" for *_, v in rows)

    def below(rows, depth, share, out):
        """rows: (host, path, segments, verdict) of one node."""
        if not counts(rows)[0] or depth and len({r[1] for r in rows}) == 1:
            return out.update({(h, p): share for h, p, *_ in rows})
        out.update({(h, p): share for h, p, s, _ in rows if len(s) <= depth})
        rows = [r for r in rows if len(r[2]) > depth]
        names = {r[2][depth] for r in rows}
        varied = len(names) >= url_filter.VARIED and len(names) * url_filter.PAGES_EACH >= len(rows)
        steps = collections.defaultdict(list)
        for r in rows:
            steps["*" if varied else r[2][depth]].append(r)
        sides = {}
        for step, own in steps.items():
            n, b = counts(own)
            spread = (max(share * (1 - share), 1e-6) / n) ** 0.5 if n else 0
            sides[step] = 0 if not n or abs(b / n - share) <= url_filter.SIMILAR * spread else 1 if b / n > share else -1
        for step, own in steps.items():
            n, b = (sum(x) for x in zip(*[counts(steps[o]) for o in steps if sides[o] == sides[step]]))
            below(own, depth + 1, (b + strength * share) / (n + strength) if sides[step] else share, out)

    out, start = {}, (prior, 0)
    for host in {h for h, *_ in pages}:
        share, last = start
        names = host.split(".")
        for i in range(1, len(names) + 1):
            end = ".".join(names[-i:])
            n, b = counts([r for r in pages if r[0] == end or r[0].endswith("." + end)])
            if n and n != last:
                share, last = (b + strength * share) / (n + strength), n
        below([(h, p, p.removeprefix("/").split("/"), v) for h, p, v in pages if h == host], 0, share, out)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_templates_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts, words = ["a.net", "b.a.net", "c.org", "net", "d.net", "e.com", ""], ["x", "y", "z", "en", ""]
    bad = {(h, w): rng.random() for h in hosts for w in words}
    pages = []
    for _ in range(900):
        host = rng.choice(hosts + ["a.net"] * 6)
        parts = [rng.choice([*words, str(rng.randrange(40))]) for _ in range(rng.randrange(8))]
        path = "".join("/" + p for p in parts)
        labelled = rng.random() < 0.4 and not host.startswith("d")
        pages.append((host, path, ("block" if rng.random() < bad[host, parts[0] if parts and parts[0] in words else ""] else "allow") if labelled else None))
    deep = "/k" * 5
    pages += [("a.net", deep + "/1", "block"), ("a.net", deep + "/2", None)]
    got = {(r.host, r.path): r.share for r in url_filter.templates(spark.createDataFrame(pages, "host string, path string, verdict string")).collect()}
    want = shares_by_hand(pages)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    assert len({round(v, 6) for v in got.values()}) > 5


def test_a_host_with_blocked_labels_only_blocks_its_other_branches(spark):
    pages = [f"http://n{i % 3}.net/{p}/{i}" for i in range(60) for p in ("es", "en")] + [f"http://y{i}.com/{i}" for i in range(60)] + ["http://z.org/1", "http://new.net/q"]
    found = {r.url: r.verdict for r in url_filter.judged(spark.createDataFrame([(u,) for u in pages], "url string")).collect()}
    assert all(v == ("allow" if ".com/" in u or ".org/" in u else "block") for u, v in found.items())


# ----------------------------------------------------------------------- BPE


def test_bpe_is_that_of_the_library(make):
    with open(RANKS, "rb") as file:
        ranks = bpe.read_ranks(file)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeth inor\n\t é漢🙂0123!?_-") for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += [None, "", "a" * 3000, " " * 999 + "x", "ab" * 2000, "é" * 500, "<|endoftext|>", "🙂" * 300, "supercalifragilistic" * 40]
    rows = bpe.tokenize(make(list(enumerate(texts))).withColumn("n_tokens", F.lit("x")), RANKS, public_tokenizers.PATTERN, ids=True).collect()
    for r in rows:
        want = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.token_ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert bpe.tokenize(make([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_full_tables_are_emptied(monkeypatch):
    with open(RANKS, "rb") as file:
        source = file.read()
    monkeypatch.setattr(bpe.Transducer, "MAX_STATES", 50)
    monkeypatch.setattr(bpe.PieceIds, "MAX_PIECES", 20)
    ranks = bpe.read_ranks(source.splitlines())
    known = bpe.PieceIds(bpe.Transducer(ranks))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for k in range(200):
        piece = f" word{chr(97 + k % 26)}ing{chr(97 + k // 26)}s"
        assert np.frombuffer(known[piece], "<u4").tolist() == library.encode_ordinary(piece)
    assert len(known) <= 20


def test_decoding_cuts_between_code_points():
    text = "aé漢🙂" * 50
    tokens = [bytes([i]) for i in range(256)]
    parts = list(bpe.decode_stream(text.encode(), tokens, block=5))
    assert b"".join(parts).decode() == text and all(p.decode() is not None for p in parts)


# ------------------------------------------------------------------- quality


def test_quality_of_held_out_rows(spark, make):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(5, 60))]
        bad = i % 4 == 0
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in words)))
        labels.append((i, int(not bad)))
    docs = make([*rows, (None, None), (1000, ""), (2, rows[2][1])])
    train = spark.createDataFrame([x for x in labels if x[0] < 300], "doc_id long, quality int")
    model = quality.learn(docs, train)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = [(i, y) for i, y in labels if i >= 300]
    assert sum((got[i] >= 0.5) == bool(y) for i, y in held) >= 0.95 * len(held)
    assert all(0 <= s <= 1 for s in got.values()) and got[None] == got[1000]
    assert quality.learn(docs, train.where("quality = 1")) == 1.0 and quality.learn(docs, train.limit(0)) == 0.5
    assert quality.score(make([]), model).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF))
        if name != "byte_bpe":
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
    assert 0.7 * before < docs.count() <= before
    assert docs.count() == corpus_pipeline.run(spark, SF).count()


def test_pipeline_with_odd_rows(spark):
    text = "some words that nobody has written before in just this order"
    rows = [(1, text, "x"), (2, text, "x"), (None, None, "x"), (3, None, "x"), (4, "", "x"), (None, text, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF))
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 0, 1, 2, 3, 4]
