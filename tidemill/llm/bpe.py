"""Byte-level BPE encoding and decoding by replaying the merges over many words at once.

Every distinct word of a block of documents is laid out as byte symbols in one flat sequence. An
inverted index leads from each token pair, named by the token it merges into, to the positions where
it stands; the merges are applied in rank order, and a merge updates only the pairs with its two
neighbours. Words met in earlier blocks of the same task are not replayed again. Merges never cross
words, so replaying each task's words is the same as replaying the whole corpus, and nothing is
shuffled.

Nulls and empty texts give no ids. Repeated rows give a row each. Columns other than the id and the
text are not read. Long texts are cut into words piece by piece.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemill.llm.common import by_bytes, columns, give_back, read_bounded, small_batches, strings, tidy

BLOCK_BYTES = 3 << 20  # text whose words are replayed together
CACHED_WORDS = 150_000  # words a task remembers, at most
CACHED_LENGTH = 64  # longer words are replayed again
WORDS_PER_PIECE = 1 << 16


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    """Token -> rank from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, blob.splitlines())}


class MergeReplay:
    """The merges of a rank file, replayed over words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # Every pair of tokens that makes up a token, as left << 32 | right, and the token.
        pairs = sorted(
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        )
        self.pair, self.result = np.array([*pairs, (1 << 62, -1)], np.int64).T

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token each pair merges into, which is also its rank; -1 where there is none."""
        wanted = left << 32 | right
        at = self.pair.searchsorted(wanted)
        return np.where((self.pair[at] == wanted) & (left >= 0) & (right >= 0), self.result[at], -1)

    def encode(self, words: Iterable[bytes]) -> list[bytes]:
        """Token ids of each word, packed as little-endian unsigned 32-bit integers."""
        whole: list[int | None] = []  # a word that is itself a token needs no merges
        split: list[bytes] = []
        for word in words:
            whole.append(self.ranks.get(word))
            if whole[-1] is None:
                split.append(word)
        ends = np.cumsum([0] + [len(w) + 1 for w in split])
        # One flat sequence: words stand apart by a gap, so that no pair crosses two of them.
        symbol = np.full(ends[-1] + 1, -1, np.int64)
        gap = np.zeros(len(symbol), bool)
        gap[ends] = True
        symbol[~gap] = self.byte[np.frombuffer(b"".join(split), np.uint8)]
        self._replay(symbol)
        used = symbol >= 0
        packed = symbol[used].astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(used)])[ends]).tolist()
        parts = map(packed.__getitem__, map(slice, cuts, cuts[1:]))
        return [next(parts) if rank is None else rank.to_bytes(4, "little") for rank in whole]

    def _replay(self, symbol: np.ndarray) -> None:
        """Apply all merges in place; a symbol that another one has taken in becomes -1."""
        after = np.arange(1, len(symbol) + 1)
        before = np.arange(-1, len(symbol) - 1)
        index: dict[int, list[tuple[int, int, np.ndarray]]] = {}  # rank -> (left, right, positions) of its pairs
        waiting: list[int] = []
        starts, taken = np.zeros(len(symbol), bool), np.zeros(len(symbol), bool)

        def note(positions: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            rank = self.merged(left, right)
            good = np.flatnonzero(rank >= 0)
            if not len(good):
                return
            pair = left[good] << 32 | right[good]
            order = np.argsort(pair, kind="stable")
            good, pair = good[order], pair[order]
            cuts = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
            found, where = rank[good], positions[good]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                r, p = int(found[lo]), int(pair[lo])
                if r not in index:
                    index[r] = []
                    heapq.heappush(waiting, r)
                index[r].append((p >> 32, p & 0xFFFFFFFF, where[lo:hi]))

        if len(symbol) > 1:
            note(np.arange(len(symbol) - 1), symbol[:-1], symbol[1:])
        while waiting:
            rank = heapq.heappop(waiting)
            live = []
            for left, right, where in index.pop(rank):  # pairs that an earlier merge has broken are skipped
                live.append(where[(symbol[where] == left) & (symbol[after[where]] == right)])
            here = live[0] if len(live) == 1 else np.concatenate(live)
            here = np.unique(here)
            if not len(here):
                continue
            there = after[here]
            starts[here] = True
            if starts[there].any():  # as in a run of one letter: of overlapping pairs, the leftmost comes first
                chosen, last = [], -1
                for i, j in zip(here.tolist(), there.tolist(), strict=True):
                    if i != last:
                        chosen.append(i)
                        last = j
                starts[here] = False
                here = np.array(chosen)
                there = after[here]
            else:
                starts[here] = False
            # What stands beside each new token once it is made, those to its right being still unmerged.
            taken[there] = True
            left_at = before[here]
            left = np.where(taken[left_at], rank, symbol[left_at])
            taken[there] = False
            right = symbol[after[there]]
            made = np.full(len(here), rank)
            first = np.minimum(_or_high(self.merged(left, made)), _or_high(self.merged(made, right)))
            if (low := np.flatnonzero(first < rank)).size:  # a better merge appears: the rest of this one waits
                cut = int(low[0]) + 1
                rest = here[cut:]
                here, there, made = here[:cut], there[:cut], made[:cut]
                for code in np.unique(symbol[rest] << 32 | symbol[after[rest]]).tolist():
                    some = rest[(symbol[rest] << 32 | symbol[after[rest]]) == code]
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(waiting, rank)
                    index[rank].append((code >> 32, code & 0xFFFFFFFF, some))
            symbol[here] = rank
            symbol[there] = -1
            beyond = after[there]
            after[here] = beyond
            before[beyond] = here
            left_at = before[here]
            note(
                np.concatenate([here, left_at]),
                np.concatenate([made, symbol[left_at]]),
                np.concatenate([symbol[beyond], made]),
            )

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class CorpusEncoder:
    """Encodes blocks of texts, replaying only words that are not remembered."""

    def __init__(self, replay: MergeReplay, pattern: str):
        self.replay, self.pattern, self.known = replay, regex.compile(pattern), {}

    def pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= 4 * WORDS_PER_PIECE:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while piece := [m[0] for m in islice(found, WORDS_PER_PIECE)]:
            yield piece

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        waiting = 0
        for k, text in enumerate(texts):
            for piece in self.pieces(text):
                held.append((k, piece))
                waiting += len(piece)
                if waiting > 32 * WORDS_PER_PIECE:
                    self._finish(held, out)
                    held, waiting = [], 0
        self._finish(held, out)
        return [b"".join(parts) for parts in out]

    def _finish(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        known = self.known
        new = list(set().union(*(piece for _, piece in held)).difference(known))
        ids = self.replay.encode([word.encode() for word in new])
        known.update(zip(new, ids, strict=True))
        for k, piece in held:
            out[k].append(b"".join(map(known.__getitem__, piece)))
        for word in new:
            if len(word) > CACHED_LENGTH:
                del known[word]


def _or_high(rank: np.ndarray) -> np.ndarray:
    return np.where(rank < 0, 1 << 40, rank)


_ENCODERS: dict[tuple[int, str], CorpusEncoder] = {}


def _encoder(blob: bytes, pattern: str) -> CorpusEncoder:
    key = (hash(blob), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = CorpusEncoder(MergeReplay(parse_ranks(blob)), pattern)
    return _ENCODERS[key]


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids) per row; ids are packed little-endian unsigned 32-bit integers."""
    blob = read_bounded(ranks_path)
    source = columns(docs, id_col, text_col)
    source = source.select(source[0], source[1].cast("string"))
    schema = f"`{id_col}` {source.dtypes[0][1].replace('void', 'bigint')}, n_tokens bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(blob, pattern)
        for batch in batches:
            texts = strings(batch.column(1))
            for lo, hi in by_bytes([len(t) for t in texts], BLOCK_BYTES):
                ids = encoder.packed(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=[id_col, "n_tokens", "ids"],
                )
                del ids
                give_back()  # a block leaves many small objects behind

    return small_batches(source).mapInArrow(tidy(run), schema)


def decode_documents(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """The columns of `encoded` but for the ids, and `decoded`: the bytes they stand for."""
    blob = read_bounded(ranks_path)
    kept = [c for c in encoded.columns if c != ids_col]
    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes if n != ids_col) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: text for text, rank in parse_ranks(blob).items()}
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = [
                    b"".join(map(token.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                    for x in part.column(ids_col).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(texts, pa.binary())], names=[*kept, "decoded"]
                )
            give_back()

    return small_batches(encoded).mapInArrow(tidy(run), schema)
