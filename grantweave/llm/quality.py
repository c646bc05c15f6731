"""Quality classifier: random-indexing word vectors pooled by document, and a small calibrated network.

A token is a word in lower case; its last bytes and its shape (runs of letter cases, digits and signs)
are read beside it. Each of the three has a sparse random index vector that follows from its own hash.
A word's context vector is the sum of the index vectors of the words next to it over the whole corpus,
so words that occur alike point alike; every word has its own, however many there are. A document's
vector pools the index vectors of its words, endings and shapes and the context vectors of its words, and
has, as repeats don't show in a mean, the share of words that repeat the one before and the logarithms
of its numbers of words and of distinct words.

1. Each task reads blocks of texts. A block sends each distinct word once, with the sums of its
   neighbours in the block, to the word's bucket, and packs which words its documents hold.
2. A bucket adds the blocks' sums, whole numbers, and answers each block with its words' vectors.
3. Answers and packed documents meet by block and become pooled vectors, written once: the network
   learns from the labelled ones, and scores are read off all of them.

A network with one hidden layer learns labels from the pooled vectors of at most SAMPLE labelled rows
(those with the smallest hashes of their ids); a part of them is held back to choose the weight
decay and the temperature that calibrates its probabilities. Statistics and scores cover all rows and whole texts.

Null, empty and wordless texts have zero vectors and get the network's answer to those. Without
labelled rows of both classes every score is the share of ones, or 0.5 without any. Rows with null ids
are scored. Repeated rows give repeated results, whatever block they are in. Extra columns stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

#: Labelled rows that are learned from, at most.
SAMPLE = 20_000
#: Entries of a vector.
WIDTH = 32
#: Sums that a text gives by itself: index vectors of words, endings and shapes, and repeats.
OWN = 3 * WIDTH + 1
#: Entries of an index vector that aren't 0.
NONZERO = 2
ENDING = 3
PIECE = 1 << 20
#: Bytes of text in a block, and of a corpus for each bucket of words.
BLOCK = 32 << 20
BUCKET = 32 << 20
#: Bytes of a word's hash that travel; its bucket tells it apart further.
SENT = 6
HIDDEN = 32
DECAYS = (1e-4, 1e-3, 3e-3, 1e-2, 3e-2)
#: Length of a context vector, whose entries are rounded to whole numbers.
UNIT = 31

#: Classes of bytes in shapes: capital, small, digit, beyond ASCII, and each sign for itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[48:58], SHAPE[128:] = 65, 97, 48, 97


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each token's word, ending and shape, and each text's first token."""
    low = common.LOWER[data]
    starts, ends, first = common.word_bounds(low, offsets, common.SPACED)
    if not len(starts):
        return np.zeros((0, 3), np.uint64), first
    hashes = common.RangeHash(low)
    shape = SHAPE[data]
    # The shape without repeats: only bytes that differ from the one before, or begin a token.
    new = np.concatenate([[True], shape[1:] != shape[:-1]])
    new[starts] = True
    at = np.flatnonzero(new)
    runs = common.RangeHash(shape[at])
    place = np.searchsorted(at, starts), np.searchsorted(at, ends)
    three = np.stack([hashes.of(starts, ends), hashes.of(np.maximum(starts, ends - ENDING), ends) ^ np.uint64(0xABCDEF), runs.of(*place) ^ np.uint64(0x123456789)], axis=1)
    return common.mix(three), first


def index_entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the NONZERO entries of each hash's index vector."""
    places, signs = np.zeros((2, len(hashes), NONZERO), np.int64)
    for z in range(NONZERO):
        h = common.mix(hashes ^ np.uint64(0x9E3779B97F4A7C15 >> z))
        places[:, z] = h % np.uint64(WIDTH)
        signs[:, z] = (h >> np.uint64(40) & np.uint64(1)).astype(np.int64) * 2 - 1
    return places, signs


def index_sums(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the sum of its tokens' index vectors."""
    places, signs = index_entries(hashes)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cell = (row[:, None] * WIDTH + places).ravel()
    return np.bincount(cell, signs.ravel(), (len(first) - 1) * WIDTH).reshape(-1, WIDTH)


def repeat_counts(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the number of tokens that repeat the one before, as a column."""
    same = np.zeros(len(words), np.int64)
    same[1:] = words[1:] == words[:-1]
    same[first[:-1][np.diff(first) > 0]] = 0
    sums = np.concatenate([[0], np.cumsum(same)])
    return np.diff(sums[first])[:, None]


def add_neighbours(sums: np.ndarray, words: np.ndarray, row: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Adds to each word's sums the index vectors of its left and right neighbours in a text."""
    near = np.flatnonzero(row[1:] == row[:-1])
    for own, other in ((near, near + 1), (near + 1, near)):
        for z in range(NONZERO):
            np.add.at(sums, (words[own], places[words[other], z]), signs[words[other], z].astype(np.int32))


def context_vectors(sums: np.ndarray) -> np.ndarray:
    """Sums as whole numbers at length UNIT; none where there are no neighbours."""
    out = np.zeros(sums.shape, np.int8)
    for a in range(0, len(sums), 1 << 14):
        some = sums[a : a + (1 << 14)].astype(np.float64)
        length = np.sqrt((some**2).sum(axis=1, keepdims=True))
        out[a : a + (1 << 14)] = np.rint(some * (UNIT / np.where(length, length, 1)))
    return out


_CODEC = pa.Codec("zstd", compression_level=9)


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as planes of their bytes, small ones first, compressed."""
    if not values.size:
        return b""
    planes = np.ascontiguousarray(values.reshape(-1, 1)).view(np.uint8).reshape(values.size, -1).T
    return _CODEC.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _restored(data: pa.Scalar, kind: str, size: int) -> np.ndarray:
    if not size:
        return np.zeros(0, kind)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data.as_buffer(), size * width, "zstd"), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 31)).astype(np.uint32)


def _unzigzag(x: np.ndarray) -> np.ndarray:
    return (x >> 1).astype(np.int32) ^ -(x & 1).astype(np.int32)


_X = "_pooled_vector"
#: target: a bucket of words, or below 0 where a block's own documents only pass.
_SENT = "target long, bucket int, block long, size long, words binary, sums binary, bag binary, rows binary"
_MET = "block long, bucket int, size long, vectors binary, words binary, bag binary, rows binary"


def _row(ddl: str, **values) -> pa.RecordBatch:
    """One row; columns without a value are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names = [c.split() for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], kinds[k]) for n, k in names], names=[n for n, _ in names])


def _blocks(text: str, keep: list[str], buckets: int, sums: bool, bags: bool):
    """What the blocks of a frame send: their words by bucket and, with bags, their documents."""

    def block(held: list) -> Iterator[pa.RecordBatch]:
        sizes = np.concatenate([h[2] for h in held])
        # Words are numbered as they come first, so frequent ones have small numbers.
        found, at, number = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        order = np.argsort(at)
        own, rank = found[order], np.empty(len(at), np.int32)
        rank[order] = np.arange(len(at), dtype=np.int32)
        cuts = np.cumsum([len(h[0]) for h in held])[:-1]
        # A piece's words by their numbers, and the row of each token.
        pieces = [(n[h[1]], np.repeat(np.arange(len(h[2]), dtype=np.int32), h[2])) for n, h in zip(np.split(rank[number], cuts), held, strict=True)] if len(own) else []
        bucket = common.mix(own) % np.uint64(buckets)
        near = np.zeros((len(own), WIDTH), np.int32)
        if sums:
            entries = index_entries(own)
            for words, row in pieces:
                add_neighbours(near, words, row, *entries)
        name = -1
        if bags:
            text_rows = pa.Table.from_batches([h[3] for h in held]).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, text_rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(text_rows)
            kept = sink.getvalue().to_pybytes()
            cells = [(*np.unique(row * np.int64(len(own)) + words, return_counts=True), len(h[2])) for (words, row), h in zip(pieces, held, strict=False)]
            steps, lengths = [], []
            for cell, _, rows in cells:
                doc, word = np.divmod(cell, len(own))
                begins = np.diff(doc, prepend=-1) > 0
                steps.append(np.where(begins, word, np.diff(word, prepend=0)).astype(np.uint32))
                lengths.append(np.bincount(doc, minlength=rows).astype(np.uint32))
            none = [np.zeros(0, np.uint32)]
            step, times = np.concatenate(none + steps), np.concatenate(none + [t.astype(np.uint32) for _, t, _ in cells])
            lengths = np.concatenate(lengths) if cells else np.zeros(len(sizes), np.uint32)
            # A block's number follows from what it holds; equal blocks may share it and their vectors.
            name = int(common.mix(np.array([zlib.crc32(step.tobytes()) << 32 ^ zlib.crc32(kept)], np.uint64) + own.sum(dtype=np.uint64))[0] >> np.uint64(2))
            index = _zigzag(np.concatenate([h[4] for h in held]).astype(np.int32))
            packed = [_squeezed(x) for x in (lengths, step, times, index)]
            head = np.array([len(sizes), len(step), *map(len, packed)], np.int64).tobytes()
            yield _row(_SENT, target=-1 - name, block=name, size=len(own), words=_squeezed(bucket.astype(np.uint32)), bag=head + b"".join(packed), rows=kept)
        for b, (mine,) in common.packed(bucket.astype(np.int64), buckets, np.arange(len(own))):
            sent = _squeezed(_zigzag(near[mine]).ravel()) if sums else None
            cut = own[mine].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT]
            yield _row(_SENT, target=b, bucket=b, block=name, size=len(mine), words=np.ascontiguousarray(cut).tobytes(), sums=sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, data, offsets in common.pieces(batches, text, PIECE):
            found, first = units(data, offsets)
            index = np.concatenate([*(index_sums(found[:, k], first) for k in range(3)), repeat_counts(found[:, 0], first)], axis=1).astype(np.int32) if bags else None
            # Words in the order of their first places.
            words, at, number = np.unique(found[:, 0], return_index=True, return_inverse=True)
            order = np.argsort(at)
            rank = np.empty(len(at), np.int32)
            rank[order] = np.arange(len(at), dtype=np.int32)
            held.append((words[order], rank[number], np.diff(first), rows.select(keep) if bags else None, index))
            size += len(data)
            if size >= BLOCK:
                yield from block(held)
                held, size = [], 0
        if held:
            yield from block(held)

    return run


def _answers(key: tuple, group: pa.Table) -> pa.Table:
    """The vectors of a bucket's words for every block that asks; documents pass."""
    if key[0].as_py() < 0:
        return group.append_column("vectors", pa.nulls(len(group), pa.binary())).select([c.split()[0] for c in _MET.split(", ")])
    sizes = group.column("size").to_pylist()
    asked = []
    for data in group.column("words"):
        wide = np.zeros((len(data.as_buffer()) // SENT, 8), np.uint8)
        wide[:, :SENT] = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, SENT)
        asked.append(wide.view("<u8").ravel())
    known = np.unique(np.concatenate(asked))
    total = np.zeros((len(known), WIDTH), np.int64)
    for words, sums, size in zip(asked, group.column("sums"), sizes, strict=True):
        if sums.is_valid:
            # Two words of a block may share the bytes of their hash that are sent.
            np.add.at(total, np.searchsorted(known, words), _unzigzag(_restored(sums, "<u4", size * WIDTH)).reshape(size, WIDTH))
    vectors = context_vectors(total)
    out = [
        _row(_MET, block=block, bucket=key[0].as_py(), size=size, vectors=_CODEC.compress(np.ascontiguousarray(vectors[np.searchsorted(known, words)]).tobytes(), asbytes=True))
        for words, block, size in zip(asked, group.column("block").to_pylist(), sizes, strict=True) if block >= 0
    ]
    return pa.Table.from_batches(out, _row(_MET).schema)


def _pooled(keep: list[str]):
    """The kept columns and pooled vectors of a block's documents."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        vectors, tables = {}, []
        holds = group.column("bag").is_valid().to_pylist()
        for k in np.flatnonzero(~np.array(holds)):
            size = group.column("size")[int(k)].as_py()
            data = pa.decompress(group.column("vectors")[int(k)].as_buffer(), size * WIDTH, "zstd")
            vectors[group.column("bucket")[int(k)].as_py()] = np.frombuffer(data, np.int8).reshape(size, WIDTH)
        for k in np.flatnonzero(holds):
            count = group.column("size")[int(k)].as_py()
            bucket = _restored(group.column("words")[int(k)], "<u4", count)
            context = np.zeros((count, WIDTH), np.int8)
            for b, found in vectors.items():
                context[bucket == b] = found
            bag = memoryview(group.column("bag")[int(k)].as_buffer())
            docs, entries, *lengths = np.frombuffer(bag[:48], np.int64).tolist()
            ends = np.cumsum([48, *lengths]).tolist()
            parts = [pa.scalar(bytes(bag[a:b]), pa.binary()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            sizes = _restored(parts[0], "<u4", docs).astype(np.int64)
            steps, times = (_restored(p, "<u4", entries).astype(np.int64) for p in parts[1:3])
            first = np.cumsum(sizes) - sizes
            full = np.flatnonzero(sizes)
            words = np.cumsum(steps)
            # Steps begin anew in each document.
            words -= np.repeat((words - steps)[first[full]], sizes[full])
            rows = pa.ipc.open_stream(group.column("rows")[int(k)].as_buffer()).read_all().combine_chunks()
            index = _unzigzag(_restored(parts[3], "<u4", docs * OWN)).reshape(docs, OWN)
            x = np.concatenate([index, np.zeros((docs, WIDTH + 2))], axis=1)
            owner = np.repeat(np.arange(docs), sizes)
            for a in range(0, entries, PIECE // 16):
                some = slice(a, a + PIECE // 16)
                begin = np.flatnonzero(np.diff(owner[some], prepend=-1))
                x[owner[some][begin], OWN:-2] += np.add.reduceat(context[words[some]] * times[some, None], begin, axis=0)
            x[:, OWN:-2] /= UNIT
            tokens = np.zeros(docs)
            tokens[full] = np.add.reduceat(times, first[full]) if len(full) else 0
            x[:, :-2] /= np.maximum(tokens, 1)[:, None]
            x[:, -2], x[:, -1] = np.log1p(tokens), np.log1p(sizes)
            made = pa.array([v.tobytes() for v in x.astype(np.float16)], pa.binary())
            tables.append(rows.select(keep).append_column(_X, made))
        return pa.concat_tables(tables)

    return run


def pooled(docs: DataFrame, corpus: DataFrame, text: str, keep: list[str], corpus_text: str | None = None) -> DataFrame:
    """The kept columns of docs and the pooled vector of each text, by word vectors of the corpus."""
    same = docs is corpus
    buckets = common.bucket_count(docs.sparkSession, common.text_total(corpus, corpus_text or text), BUCKET)
    sent = docs.select(*dict.fromkeys([*keep, text])).mapInArrow(_blocks(text, keep, buckets, same, True), _SENT)
    if not same:
        others = corpus.select(corpus_text or text)
        sent = sent.union(others.mapInArrow(_blocks(corpus_text or text, [], buckets, True, False), _SENT))
    met = sent.groupBy("target").applyInArrow(_answers, _MET)
    kind = common.extended(docs.select(*keep), f"{_X} binary")
    return common.written(met.groupBy("block").applyInArrow(_pooled(keep), kind))


class Network:
    """Two layers; inputs are standardised, logits divided by the temperature. loss: on the rows held back."""

    def __init__(self, x: np.ndarray, y: np.ndarray, decay: float, steps: int = 1500, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        back = np.arange(len(x)) % 5 == 4
        z = (x - self.mean) / self.scale
        train, truth = z[~back], y[~back]
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2, self.temperature = np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), 0.0, 1.0
        names = ("w1", "b1", "w2", "b2")
        first, second = {n: 0.0 for n in names}, {n: 0.0 for n in names}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(train), min(256, len(train)))
            a, t = train[pick], truth[pick]
            h = np.tanh(a @ self.w1 + self.b1)
            error = (_sigmoid(h @ self.w2 + self.b2) - t) / len(a)
            back_h = np.outer(error, self.w2) * (1 - h * h)
            slopes = {"w1": a.T @ back_h + decay * self.w1, "b1": back_h.sum(axis=0), "w2": h.T @ error + decay * self.w2, "b2": error.sum()}
            for n, g in slopes.items():
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                rate = 3e-3 * (1 - step / (steps + 1))
                setattr(self, n, getattr(self, n) - rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8))
        self.loss = 0.0
        if back.any():
            logits, truth = self.logits(x[back]), y[back]
            tried = np.geomspace(0.25, 8, 60)
            self.temperature = float(min(tried, key=lambda t: _loss(logits / t, truth)))
            self.loss = _loss(logits / self.temperature, truth)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def fitted(x: np.ndarray, y: np.ndarray) -> Network:
    """The network whose weight decay does best on the rows held back."""
    return min((Network(x, y, decay) for decay in DECAYS), key=lambda n: n.loss)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(_sigmoid(logits), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


@dataclass
class Model:
    """A network, the corpus of its word vectors, and that corpus's pooled vectors."""

    network: Network
    corpus: DataFrame
    text: str
    vectors: DataFrame


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float16).reshape(len(values), -1).astype(float)


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, keep: list[str] | None = None,
) -> Model | float:
    """A model, or a constant where one class is missing. Scores of docs themselves have the columns of keep (all)."""
    keep = list(dict.fromkeys([doc_id, *(keep if keep is not None else docs.columns)]))
    rows = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).distinct()
    chosen = common.written(rows.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample))
    vectors = pooled(docs, docs, text, [c for c in keep if c != _X])
    used = vectors.select(F.col(doc_id).alias("_own"), F.col(_X).alias("_x")).join(F.broadcast(chosen), F.col("_own") == F.col("_id"))
    found = sorted(used.select("_id", "_label", "_x").collect(), key=lambda r: (zlib.crc32(str(r["_id"]).encode()), bytes(r["_x"]), r["_label"]))
    y = np.array([r["_label"] for r in found], float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return Model(fitted(_matrix([bytes(r["_x"]) for r in found]), y), docs, text, vectors)


def score(docs: DataFrame, model: Model | float, text: str = "text", column: str = "score") -> DataFrame:
    """Adds the probability of label 1; model comes from learn()."""
    if isinstance(model, float):
        return docs.drop(column).withColumn(column, F.lit(model))
    if docs is model.corpus:
        vectors = model.vectors.drop(column)
    else:
        vectors = pooled(docs, model.corpus, text, [c for c in docs.columns if c not in (column, _X)], model.text)
    sent, names = docs.sparkSession.sparkContext.broadcast(model.network), [c for c in vectors.columns if c != _X]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            p = sent.value.probability(_matrix(rows.column(_X).to_pylist())) if rows.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(p, pa.float64())], names=[*names, column])

    return vectors.mapInArrow(run, common.extended(vectors.select(*names), f"{column} double"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels").where(common.in_fold("doc_id", 5) != 0)
    return score(docs, learn(docs, labels, keep=["doc_id"])).select(
        "doc_id", (common.in_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
