"""Toxicity by a weighted finite-state grammar over matched clauses.

Small transducers for negation, reported speech and target are composed into one machine. It reads
the clause's words as symbols (insult, threat, target, negation, reporting verb, other) and marks each
insult or threat by what it stands under. A document's score is a logistic function of the weights
that its marked words gather by kind, so a word alone counts as its clause lets it.

Insults are learned: all words and word beginnings that more labelled toxic documents hold than chance
allows, and clean ones don't. Their weights are log odds; the kinds' weights come from a logistic fit. Learning takes at most SAMPLE labelled rows
of either class, those with the smallest hashes of their ids; scoring takes every row's whole text.

Null, empty and wordless texts score like texts without a match. Without labelled rows of both
classes nothing can be learned, and every score is 0. Rows with null ids are scored. Repeated rows
give repeated results. Extra columns stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

#: Labelled rows of class 0 and 1 that are learned from, at most.
SAMPLE = (16_000, 4_000)
#: A form must be in so many toxic documents and in such a share of the sample's, and in few clean
#: ones for each of them; and in so many that fewer than BY_CHANCE forms would be in toxic ones alone if labels were drawn.
LEAST_DOCUMENTS, LEAST_SHARE, CLEAN_SHARE, BY_CHANCE = 4, 0.002, 0.02, 0.01
#: Forms that a task counts apart before it sums them.
FOLD = 1 << 18
#: Lengths in bytes of the word beginnings that may be forms, besides whole words (0).
LENGTHS = (0, 4, 5, 6, 7)

# Closed classes of the grammar, small on purpose: pronouns, negations, verbs of saying, threats.
WORDS = {
    "target": "you your yours he she they him her them du dich dir ihr euch sie er tu te toi vous il elle ils elles tú usted ustedes vosotros él ella ellos",
    "negation": "not no never neither nor nicht kein keine keiner nie niemals pas jamais aucun aucune ne nunca jamás ningún ninguna tampoco",
    "reporting": "said says say called calls wrote reported quoted sagte sagt nannte schrieb dit disait appelle écrit dijo dice llamó escribió",
    "threat": "kill hurt destroy beat punish töten schlagen zerstören vernichten tuer frapper détruire matar golpear destruir",
}

LETTERS = np.zeros(256, bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
CLAUSE_END = np.zeros(256, bool)
CLAUSE_END[list(b".!?;:\n|")] = True

INSULT, THREAT, TARGET, NEGATION, REPORTING, OTHER = range(6)
#: Words that a negation and a target reach.
REACH = 4


class Machine:
    """A transducer that copies its input and adds a mark to insults and threats."""

    def __init__(self, start, move):
        self.start, self.move = start, move

    def then(self, other: Machine) -> Machine:
        """The composition: both read each symbol, and the marks join."""

        def move(state, symbol):
            (a, one), (b, two) = self.move(state[0], symbol), other.move(state[1], symbol)
            return (a, b), one | two

        return Machine((self.start, other.start), move)

    def determinised(self) -> tuple[list[list[int]], list[list[frozenset]]]:
        """Tables of next states and marks by state and symbol; state 0 is the start."""
        number, todo, moves, marks = {self.start: 0}, [self.start], [], []
        for state in todo:
            found = [self.move(state, symbol) for symbol in range(6)]
            for after, _ in found:
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
            moves.append([number[after] for after, _ in found])
            marks.append([mark for _, mark in found])
        return moves, marks


def _within(opener: int, name: str, reach: int | None) -> Machine:
    """Marks what follows the opener: within so many words, or up to the clause's end."""

    def move(state: int, symbol: int):
        mark = frozenset([name]) if state and symbol in (INSULT, THREAT) else frozenset()
        after = (reach or 1) if symbol == opener else state if reach is None else max(0, state - 1)
        return after, mark

    return Machine(0, move)


GRAMMAR = _within(NEGATION, "negated", REACH).then(_within(REPORTING, "reported", None)).then(_within(TARGET, "targeted", REACH))
MOVES, MARKS = GRAMMAR.determinised()
KINDS = ("plain", "targeted", "negated", "reported", "threat", "weak threat")


def kind_of(symbol: int, marks: frozenset) -> int:
    if symbol == THREAT:
        return 4 if "targeted" in marks and not marks & {"negated", "reported"} else 5
    return 3 if "reported" in marks else 2 if "negated" in marks else 1 if "targeted" in marks else 0


class Lexicon:
    """Forms by length: hashes, symbols and weights."""

    def __init__(self, insults: list[tuple[int, bytes, float]]):
        forms = [(n, text, INSULT, weight) for n, text, weight in insults]
        for name, symbol in (("target", TARGET), ("negation", NEGATION), ("reporting", REPORTING), ("threat", THREAT)):
            forms += [(0, w.encode(), symbol, 1.0) for w in WORDS[name].split()]
        self.by_length = {}
        for n in {f[0] for f in forms}:
            own = sorted({hash_of(text): (symbol, weight) for k, text, symbol, weight in reversed(forms) if k == n}.items())
            self.by_length[n] = (
                np.array([h for h, _ in own], np.uint64), np.array([s for _, (s, _) in own], np.int8), np.array([w for _, (_, w) in own]),
            )

    def read(self, hashes: RangeWords) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and weight of each word; a learned form wins over a closed class."""
        symbols, weights = np.full(len(hashes.starts), OTHER, np.int8), np.zeros(len(hashes.starts))
        for n, (known, kinds, values) in sorted(self.by_length.items(), reverse=True):
            h, usable = hashes.of(n)
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = np.flatnonzero((known[at] == h) & usable & (symbols != INSULT))
            symbols[hit], weights[hit] = kinds[at[hit]], values[at[hit]]
        return symbols, weights


class RangeWords:
    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low = common.LOWER[data]
        self.starts, self.ends, self.first = common.word_bounds(self.low, offsets, LETTERS)
        self.hash = common.RangeHash(self.low)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words (0) or their beginnings, and which are long enough."""
        if not length:
            return self.hash.of(self.starts, self.ends), np.ones(len(self.starts), bool)
        return self.hash.of(self.starts, np.minimum(self.starts + length, self.ends)), self.ends - self.starts >= length


def hash_of(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(common.RangeHash(data).of(np.array([0]), np.array([len(data)]))[0])


def clause_sums(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """For each text the weights gathered by kind: the machine runs over clauses with a match."""
    words = RangeWords(data, offsets)
    sums = np.zeros((len(offsets) - 1, len(KINDS)))
    symbols, weights = lexicon.read(words)
    matched = np.flatnonzero((symbols == INSULT) | (symbols == THREAT))
    if not len(matched):
        return sums
    text = np.searchsorted(words.first, np.arange(len(symbols)), "right") - 1
    clause = np.concatenate([[0], np.cumsum(CLAUSE_END[words.low])])[words.starts] + text  # a text ends a clause
    known = np.flatnonzero(symbols != OTHER)
    known = known[np.isin(clause[known], clause[matched])]
    state, last, now = 0, -1, -1
    for k, c, s, t, w in zip(known.tolist(), clause[known].tolist(), symbols[known].tolist(), text[known].tolist(), weights[known].tolist(), strict=True):
        if c != now:
            state, now, last = 0, c, k
        for _ in range(min(k - last - 1, REACH)):
            state = MOVES[state][OTHER]
        if s in (INSULT, THREAT):
            sums[t, kind_of(s, MARKS[state][s])] += w
        state, last = MOVES[state][s], k
    return sums


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts' (form, toxic, documents) with each form once."""
    forms, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return forms, *(np.bincount(place, np.concatenate([p[k] for p in parts]), len(forms)).astype(np.int32) for k in (1, 2))


def _counts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """(form, toxic, clean): how many documents of either class hold a form, summed by task.

    Sums are taken as the texts come, so a task holds its distinct forms and at most as many again.
    """
    held, waiting, most = [], 0, FOLD
    for rows, data, offsets in common.pieces(batches, text):
        words, toxic = RangeWords(data, offsets), rows.column("toxic").to_numpy(zero_copy_only=False)
        doc = np.searchsorted(words.first, np.arange(len(words.starts)), "right") - 1
        for n in LENGTHS:
            h, usable = words.of(n)
            pairs = np.unique(np.rec.fromarrays([_form(h, n)[usable], doc[usable]]))
            part = _summed([(pairs["f0"], toxic[pairs["f1"]], np.ones(len(pairs), np.int32))])
            held.append(part)
            waiting += len(part[0])
            if waiting > most:
                held = [_summed(held)]
                waiting = len(held[0][0])
                most = max(FOLD, 2 * waiting)
    if held:
        forms, toxic, every = _summed(held)
        sums = [pa.array(c.astype(np.int64)) for c in (toxic, every - toxic)]
        yield pa.RecordBatch.from_arrays([pa.array(forms.view(np.int64)), *sums], names=["form", "toxic", "clean"])


def _form(h: np.ndarray, length: int) -> np.ndarray:
    return common.mix(h ^ np.uint64(length + 1))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: tuple[int, int] = SAMPLE):
    """(lexicon, weights of kinds, bias), or None without rows of both classes."""
    spark = docs.sparkSession
    rows = labels.where(F.col(toxic).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(toxic).cast("int").alias("toxic")).distinct()
    order = F.xxhash64("_id")
    chosen = [rows.where(F.col("toxic") == k).orderBy(order, "_id").limit(sample[k]) for k in (0, 1)]
    chosen = common.written(chosen[0].union(chosen[1]))
    # Equal texts count once, so a group of copies can't make a form.
    named = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text"))
    used = named.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", "toxic").dropDuplicates()
    used = common.written(used)
    counted = used.mapInArrow(lambda b: _counts(b, "text"), "form long, toxic long, clean long")
    counted = common.written(counted.groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 0"))
    sizes = {r.toxic: r["count"] for r in used.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    share, forms = sizes[1] / (sizes[0] + sizes[1]), counted.count()
    least = max(LEAST_DOCUMENTS, int(LEAST_SHARE * sizes[1]), math.ceil(math.log(BY_CHANCE / max(forms, 1)) / math.log(share)))
    counted = counted.where((F.col("toxic") >= least) & (F.col("clean") <= CLEAN_SHARE * F.col("toxic")))
    candidates = {r.form: (r.toxic, r.clean) for r in counted.collect()}
    sent = spark.sparkContext.broadcast(np.sort(np.array(list(candidates), np.int64).view(np.uint64)))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for rows, data, offsets in common.pieces(batches, "text"):
            words = RangeWords(data, offsets)
            doc = np.searchsorted(words.first, np.arange(len(words.starts)), "right") - 1
            for n in LENGTHS:
                h, usable = words.of(n)
                own = _form(h, n)
                at = np.flatnonzero(np.isin(own, known) & usable)
                found = {(int(d), int(f)): k for d, f, k in zip(doc[at], own[at], at, strict=True)}
                texts = [words.low[words.starts[k] : (words.starts[k] + n) if n else words.ends[k]].tobytes() for k in found.values()]
                yield pa.RecordBatch.from_arrays([
                    rows.column("text").take(pa.array([d for d, _ in found], pa.int64())).cast(pa.large_binary()).cast(pa.binary()),
                    pa.array(np.array([f for _, f in found], np.uint64).view(np.int64)), pa.array([n] * len(found), pa.int32()), pa.array(texts, pa.binary()),
                ], names=["doc", "form", "length", "word"])

    # Of toxic documents only, and no more than the sample's rows.
    hits = used.where("toxic = 1").mapInArrow(held, "doc binary, form long, length int, word binary")
    hits = hits.select("form", "length", "word").distinct().collect()
    insults = []
    for r in sorted(hits, key=lambda r: (r.length, r.word)):
        t, c = candidates[r.form]
        insults.append((r.length, bytes(r.word), float(np.log((t + 0.5) / (sizes[1] + 1)) - np.log((c + 0.5) / (sizes[0] + 1)))))
    lexicon = Lexicon(insults)
    sums = used.select("toxic", "text").mapInArrow(lambda b: _kinds(b, "text", lexicon, ["toxic"]), "toxic int, sums array<double>").collect()
    x, y = features([r.sums for r in sums]), np.array([r.toxic for r in sums], float)
    weights, bias = fit(x, y)
    return lexicon, weights, bias


def features(sums: np.ndarray) -> np.ndarray:
    """What the logistic function sees: targeted insults count as plain ones too, so a target never weakens one."""
    both = np.array(sums, float).reshape(-1, len(KINDS))
    both[:, 0] += both[:, 1]
    return np.log1p(both)


def _kinds(batches: Iterator[pa.RecordBatch], text: str, lexicon: Lexicon, kept: list[str]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in common.pieces(batches, text):
        sums = clause_sums(data, offsets, lexicon)
        yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(sums.tolist(), pa.list_(pa.float64()))], names=[*kept, "sums"])


def fit(x: np.ndarray, y: np.ndarray, steps: int = 3000) -> tuple[np.ndarray, float]:
    """Logistic weights, none negative, by gradient steps with a small pull to 0.5."""
    w, b = np.full(x.shape[1], 0.5), -2.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        w = np.maximum(w - 0.5 * (x.T @ error / len(y) + 1e-3 * (w - 0.5)), 0)
        b -= 0.5 * error.mean()
    return w, float(b)


def score(docs: DataFrame, model, text: str = "text", column: str = "score") -> DataFrame:
    """Adds the score; model comes from learn()."""
    plain = docs.drop(column)
    if model is None:
        return plain.withColumn(column, F.lit(0.0))
    sent, names = docs.sparkSession.sparkContext.broadcast(model), plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights, bias = sent.value
        for rows, data, offsets in common.pieces(batches, text):
            logit = features(clause_sums(data, offsets, lexicon)) @ weights + bias
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(1 / (1 + np.exp(-logit)))], names=[*names, column])

    return plain.mapInArrow(run, common.extended(plain, f"{column} double"))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.table(spark, sf_dir, "labels").where(common.in_fold("doc_id", 5) != 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, learn(docs, training_labels(spark, sf_dir)))
    return scored.select(
        "doc_id", (common.in_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
