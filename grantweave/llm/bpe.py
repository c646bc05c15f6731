"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

Encoding. BPE encodings are stable under cutting at token borders, so each prefix of a piece has one
last token: the only token that ends there and fits behind the last token of the prefix before it.
A state of the transducer holds the pending bytes and, for every pending place where a later token
may still begin, the tokens that lead to it. Reading a byte adds a place, drops the places from
which no token can go on, and emits the tokens on which all places that are left agree. No place
lives longer than the longest token, which bounds the lookahead. States and transitions are made
when first met and kept; the tables are emptied when they grow beyond a fixed size.

Decoding joins the bytes of token ids in blocks; a UTF-8 state machine keeps back the bytes of a
code point that is not complete until the next block.

Null and empty texts give no tokens, whose digests are those of no bytes. Rows are independent, so
repeated rows give repeated results. Columns of other names pass through.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from grantweave.llm import common

DEFAULT_RANKS = "byte_bpe_50k.tiktoken"


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Transducer:
    MAX_STATES = 300_000
    FEW = 6

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.starts: dict[bytes, list[int]] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            found = self._merged(token, rank) if len(token) > 1 else [rank]
            if len(found) == 2:
                self.parts[rank] = (found[0], found[1])
                self.pairs[found[0], found[1]] = rank
            else:  # one byte, or a token that merging never makes
                self.parts[rank] = None if len(token) == 1 else ()
            if self.parts[rank] != ():
                for n in range(1, len(token)):
                    self.starts.setdefault(token[:n], []).append(rank)
        self.on: dict[tuple[int, bytes], bool] = {}
        self.fit: dict[tuple[int, int], bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.moves: list[dict[int, tuple[tuple[int, ...], int]]] = []
        self.tails: list[tuple[int, ...]] = []
        self.start = self._state((b"", ((0, (-1,)),)))

    def _merged(self, token: bytes, below: int) -> list[int]:
        """The token's bytes after all merges that rank below its own."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """True if merging the bytes of both tokens gives these two tokens.

        Goes back in time: undoes the later of both merges, and asks at each moment whether a merge
        over the seam would have come before the one undone last.
        """
        known = self.fit.get((left, right))
        if known is None:
            known = self._fits(left, right)
            if len(self.fit) > 1_000_000:
                self.fit.clear()
            self.fit[left, right] = known
        return known

    def _fits(self, left: int, right: int) -> bool:
        limit = 1 << 40
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            a, b = self.parts[left], self.parts[right]
            if a and (not b or left > right):
                limit, left = left, a[1]
            elif b:
                # On equal ranks the left one merges first, so a seam merge of the same rank wins.
                limit, right = right + 1, b[0]
            else:
                return True

    def goes_on(self, left: int, text: bytes) -> bool:
        """False if no token longer than text that begins with it fits behind the left one.

        Only asked of the tokens if they are few; a place that is kept in vain does no harm.
        """
        tokens = self.starts[text]
        if left < 0 or len(tokens) > self.FEW:
            return True
        known = self.on.get((left, text))
        if known is None:
            if len(self.on) > 1_000_000:
                self.on.clear()
            known = self.on[left, text] = any(self._fits(left, token) for token in tokens)
        return known

    def _state(self, key: tuple) -> int:
        state = self.ids.get(key)
        if state is None:
            state = self.ids[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
            self.tails.append(key[1][-1][1][1:])
        return state

    def _move(self, state: int, byte: int) -> tuple[tuple[int, ...], int]:
        pending, places = self.keys[state]
        pending += bytes((byte,))
        path, live = None, []
        for place in places:
            at, way = place
            text = pending[at:]
            last = way[-1]
            if path is None:
                token = self.ranks.get(text)
                if token is not None and self.parts[token] != () and (last < 0 or self.fits(last, token)):
                    path = (*way, token)
            if text in self.starts and self.goes_on(last, text):
                live.append(place)
        live.append((len(pending), path))
        shared, first = 1, live[0][1]
        for token in first[1:]:
            if any(len(way) <= shared or way[shared] != token for _, way in live):
                break
            shared += 1
        cut = live[0][0]
        key = (pending[cut:], tuple((at - cut, way[shared - 1 :]) for at, way in live))
        move = self.moves[state][byte] = (first[1:shared], self._state(key))
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.keys) > self.MAX_STATES:
            self._clear()
        state, out, moves = self.start, [], self.moves
        for byte in piece:
            move = moves[state].get(byte) or self._move(state, byte)
            if move[0]:
                out += move[0]
            state = move[1]
        out += self.tails[state]
        return out


class PieceIds(dict):
    """Encoded bytes of the pieces met so far; emptied when it grows beyond a fixed size."""

    MAX_PIECES = 700_000

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.MAX_PIECES:
            self.clear()
        ids = np.array(self.transducer.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


#: Length of a code point by its first byte; 0 marks a byte within one.
_LENGTH = [1] * 0x80 + [0] * 0x40 + [2] * 0x20 + [3] * 0x10 + [4] * 8 + [1] * 8


def complete(data: bytes) -> int:
    """How many bytes end with a whole code point: the machine's state is what is left."""
    for back in range(1, min(3, len(data)) + 1):
        if need := _LENGTH[data[-back]]:
            return len(data) - back if need > back else len(data)
    return len(data)


def decode_stream(ids: Iterable[int], tokens: list[bytes], block: int = 4096) -> Iterator[bytes]:
    """The text's bytes, cut only between code points."""
    rest = b""
    ids = list(ids)
    for at in range(0, len(ids), block):
        data = rest + b"".join(map(tokens.__getitem__, ids[at : at + block]))
        end = complete(data)
        rest = data[end:]
        yield data[:end]
    if rest:
        yield rest


_loaded: dict[str, tuple] = {}


def _tools(source: bytes, pattern: str, share: float = 1.0) -> tuple:
    key = f"{hashlib.sha256(source + pattern.encode()).hexdigest()} {share}"
    if key not in _loaded:
        ranks = read_ranks(source.splitlines())
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        known = PieceIds(Transducer(ranks))
        known.MAX_PIECES = int(share * known.MAX_PIECES)
        known.transducer.MAX_STATES = int(share * known.transducer.MAX_STATES)
        _loaded[key] = regex.compile(pattern), known, tokens
    return _loaded[key]


def tokenize(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: bool = False, share: float = 1.0) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256, and with ids=True token_ids; drops nothing.

    The vocabulary is read by the driver; its size doesn't depend on the texts. share: of the full size
    of a worker's tables (about 500 MB); smaller ones are emptied more often, which costs time, and
    go with the task, so a worker that is used again doesn't hold them.
    """
    with open(ranks_path, "rb") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, known, tokens = _tools(source.value, pattern, share)
        split = find.findall
        gc.disable()  # the tables hold millions of tuples and no cycles; walking them costs a third of the time
        try:
            yield from coded(batches, known, tokens, split)
        finally:
            gc.enable()
            if share < 1:
                _loaded.clear()

    def coded(batches, known, tokens, split) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in common.pieces(batches, text):
            counts, first, second, numbered = [], [], [], []
            for value in rows.column(text).to_pylist():
                data = b"".join(map(known.__getitem__, split(value or "")))
                numbers = np.frombuffer(data, "<u4")
                counts.append(len(numbers))
                first.append(hashlib.sha256(data).hexdigest())
                sha = hashlib.sha256()
                for part in decode_stream(numbers.tolist(), tokens):
                    sha.update(part)
                second.append(sha.hexdigest())
                if ids:
                    numbered.append(numbers.astype(np.int32))
            kept = [rows.column(c) for c in others]
            made = [pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            made += [pa.array(numbered, pa.list_(pa.int32()))] * ids
            yield pa.RecordBatch.from_arrays(kept + made, names=[*others, *new])

    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * ids]
    others = [c for c in docs.columns if c not in new]
    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    plain = docs.select(*others)
    return plain.mapInArrow(run, common.extended(plain, kinds))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = tokenize(docs, public_tokenizers.path(DEFAULT_RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
