"""Benchmark decontamination: an FM-index for each shard of the texts, searched for test phrases.

A shard is a run of whole documents of a few MB. Its words become symbols: those of the phrases get
numbers, all others and the borders between documents get 0. Stretches too short for any phrase are
left out, since nothing can occur there. The rest gets a suffix order by prefix doubling, its
Burrows-Wheeler transform a wavelet matrix, and every 16th place a sampled suffix position. All
phrases are searched backwards at once; occurrences are located by walking to a sampled position.

The phrases travel to the shards by broadcast in blocks of bounded size; with more than one block the
texts are searched once for each, and the occurrences of all blocks are merged.

Null, empty and wordless texts or items have no words: nothing is hit, and such items occur nowhere.
Repeated rows give repeated results; repeated items count by their id, rows of one item_id as one item.
Ids of documents may be null. Extra columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

WINDOW = 10
SAMPLE = 16
#: Bytes of benchmark texts in one broadcast block.
BLOCK_BYTES = 16 << 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start places of all suffixes in order, by prefix doubling."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], symbols[order][1:] != symbols[order][:-1]]))
    step = 1
    while n and rank[order[-1]] < n - 1:
        after = np.full(n, -1, np.int64)
        after[:-step] = rank[step:]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        step *= 2
    return order


class WaveletMatrix:
    """Ranks and symbols of a sequence of small numbers, one bit vector for each binary digit."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.levels = []
        for d in range(digits - 1, -1, -1):
            bits = (symbols >> d & 1).astype(np.int64)
            ones = np.concatenate([[0], np.cumsum(bits)])
            zeros = len(symbols) - int(ones[-1])
            self.levels.append((d, ones, zeros))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at
        for d, ones, zeros in self.levels:
            one = (symbol >> d & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros_like(at)
        for d, ones, zeros in self.levels:
            one = ones[at + 1] - ones[at]
            value |= one << d
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return value


class FMIndex:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        """symbols: small numbers below alphabet; 0 ends every stretch."""
        n = len(symbols)
        order = suffix_order(symbols)
        last = symbols[order - 1]
        self.matrix = WaveletMatrix(last, max(1, int(alphabet - 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        marked = (order % SAMPLE == 0) | (last == 0)  # so no walk leaves its stretch
        self.sampled = np.concatenate([[0], np.cumsum(marked)])
        self.marked, self.positions, self.n = marked, order[marked], n

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (right-aligned symbols)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        active = np.arange(len(phrases))
        for back in range(width):
            active = active[(lengths[active] > back) & (low[active] < high[active])]
            if not len(active):
                break
            symbol = phrases[active, width - 1 - back]
            low[active] = self.before[symbol] + self.matrix.rank(symbol, low[active])
            high[active] = self.before[symbol] + self.matrix.rank(symbol, high[active])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in these rows."""
        places, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo, at = np.arange(len(rows)), rows.copy()
        while len(todo):
            done = self.marked[at]
            places[todo[done]] = self.positions[self.sampled[at[done]]] + steps[todo[done]]
            todo, at = todo[~done], at[~done]
            symbol = self.matrix.symbol(at)
            at = self.before[symbol] + self.matrix.rank(symbol, at)
            steps[todo] += 1
        return places


class Phrases:
    """The distinct windows of benchmark items, as right-aligned rows of symbols."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        known: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = {}
        for item, text in items:
            words = WORD.findall((text or "").encode().translate(common.LOWER_BYTES))
            ids = [known.setdefault(w, len(known) + 1) for w in words]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), set()).add(item)
        self.lengths = np.array([len(p) for p in found], np.int64)
        width = int(self.lengths.max(initial=0))
        self.rows = np.zeros((len(found), width), np.int64)
        for row, p in zip(self.rows, found, strict=True):
            row[width - len(p) :] = p
        self.items = [sorted(x, key=str) for x in found.values()]
        self.alphabet = len(known) + 1
        self.shortest = int(self.lengths.min(initial=1))
        words = sorted((_hash(w), i) for w, i in known.items())
        self.hashes = np.array([h for h, _ in words], np.uint64)
        self.symbols = np.array([i for _, i in words], np.int64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbols[at], 0)


def _hash(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(common.RangeHash(data).of(np.array([0]), np.array([len(data)]))[0])


def occurrences(symbols: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of every occurrence in a shard's symbols, in which 0 ends each text."""
    inside = symbols > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= phrases.shortest
    starts, ends = starts[long_enough], ends[long_enough] + 1  # with the 0 behind
    if not len(starts) or not len(phrases.rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = ends - starts
    places = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    index = FMIndex(symbols[places], phrases.alphabet)
    low, high = index.search(phrases.rows, phrases.lengths)
    counts = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return which, places[index.locate(rows)]


def _search(docs: DataFrame, columns: list[str], text: str, items: list, window: int) -> DataFrame:
    """The columns with what one block of items finds, joined to what earlier blocks have found."""
    more = [c for c in docs.columns if c not in columns]
    sent = docs.sparkSession.sparkContext.broadcast(items)
    prepared: list[Phrases] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not prepared:
            prepared.append(Phrases(sent.value, window))
        phrases = prepared[0]
        for rows, data, offsets in common.pieces(batches, text):
            low = common.LOWER[data]
            starts, ends, first = common.word_bounds(low, offsets, common.ALNUM)
            n = len(first) - 1
            symbols = np.zeros(len(starts) + n, np.int64)
            doc = np.repeat(np.arange(n), np.diff(first))
            at = np.arange(len(starts)) + doc  # a 0 behind every text
            symbols[at] = phrases.of(common.RangeHash(low).of(starts, ends))
            which, where = occurrences(symbols, phrases)
            hit = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(hit, where, 1)
            np.add.at(hit, where + phrases.lengths[which], -1)
            covered = (np.cumsum(hit)[:-1] > 0)[at]
            owner = np.searchsorted(first + np.arange(n + 1), where, "right") - 1
            items_of: dict[int, set] = {}
            for d, p in set(zip(owner.tolist(), which.tolist(), strict=True)):
                items_of.setdefault(d, set()).update(phrases.items[p])
            runs = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]])) | np.isin(np.arange(len(covered) + 1), first))
            spans: list[list] = [[] for _ in range(n)]
            for a, b in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
                if covered[a]:
                    d = doc[a]
                    spans[d].append((a - first[d], b - first[d], starts[a] - offsets[d], ends[b - 1] - offsets[d]))
            found = [[dict(zip(_SPAN, map(int, s), strict=True)) for s in x] for x in spans]
            names = [set(map(str, items_of.get(d, ()))) for d in range(n)]
            if more:
                found = [_merged(x) for x in zip(found, rows.column("spans").to_pylist(), strict=True)]
                names = [x.union(y) for x, y in zip(names, rows.column("items").to_pylist(), strict=True)]
            hits = [sum(s["word_to"] - s["word_from"] for s in x) for x in found]
            clean = [_without(v, s) for v, s in zip(rows.column(text).to_pylist(), found, strict=True)]
            made = [
                pa.array(np.diff(first), pa.int64()), pa.array(found, _SPANS), pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                pa.array(hits, pa.int64()), pa.array(clean, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), *made], names=[*columns, *_NEW])

    return docs.mapInArrow(run, common.extended(docs.select(*columns), _FOUND))


_SPAN = ("word_from", "word_to", "byte_from", "byte_to")
_SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in _SPAN]))
_FOUND = "n_words long, spans array<struct<word_from:long,word_to:long,byte_from:long,byte_to:long>>, items array<string>, n_hit long, clean_text string"


def _without(value: str | None, spans) -> str | None:
    if not spans:
        return value
    data, at, kept = value.encode(), 0, []
    for s in spans:
        kept.append(data[at : s["byte_from"]])
        at = s["byte_to"]
    return b"".join([*kept, data[at:]]).decode()


def _merged(parts: list[list]) -> list[dict]:
    out: list[dict] = []
    for s in sorted((s for p in parts for s in p or []), key=lambda s: s["word_from"]):
        if out and s["word_from"] <= out[-1]["word_to"]:
            if s["word_to"] > out[-1]["word_to"]:
                out[-1] |= {"word_to": s["word_to"], "byte_to": s["byte_to"]}
        else:
            out.append(dict(s))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds n_words, spans (maximal runs of words hit, with their bytes), items, n_hit and clean_text."""
    plain = docs.drop("n_words", "spans", "items", "n_hit", "clean_text")
    total = items.agg(F.coalesce(F.sum(F.octet_length(text) + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // BLOCK_BYTES))
    found = plain
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64(item_id), F.lit(blocks)) == block).select(item_id, text)
        found = _search(found, plain.columns, text, [(r[0], r[1]) for r in own.collect()], window)
    return found


_NEW = ("n_words", "spans", "items", "n_hit", "clean_text")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    items = common.table(spark, sf_dir, "benchmark")
    return decontaminate(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP2_SQL = rf"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrase AS (
    SELECT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM (
        SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0
    )
),
place AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n
    )
),
found AS (SELECT doc_id, item_id, n, i FROM place JOIN phrase USING (n, p)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
