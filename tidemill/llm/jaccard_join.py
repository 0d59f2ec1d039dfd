"""Near-duplicate groups by an exact Jaccard join with adaptive multi-match prefixes.

A document's set is the distinct hashes of its word shingles. Shingles are ordered by an estimate of how
many documents hold them (counts of a fixed number of hash buckets), rare ones first. A set of n that may
link only with overlaps of t = ceil(0.75 n) or more is indexed by its first n - t + l shingles; two sets
that link share l or more of those, l being the smaller of the two. Each document chooses the l, and with it
the length of its prefix, that makes its estimated cost least: candidates met along the prefix, and those
left to verify, which fall as more shared shingles are asked for. A shared shingle counts for a pair only
if its places leave room for the overlap that the two sizes need.

Links are looked for in rounds. First each shingle's holders are compared with the one that has fewest rarer shingles,
which of near copies is the least changed, then those not yet brought together with a few others, which finds groups of
copies at a cost in proportion to their size. In the
last round all holders that these links have not brought together are compared with each other, so no link between
two components is lost, and no pair within one is made; a pair becomes a row only if what is sent along with the lists
leaves room for a link: the outlines of both, one or two bits per shingle, and short hashes of the whole prefixes, by which
the pair shares as many as it has to, wherever its other shingles are listed. For that, lists of the same holder are brought together, that with the smallest hash of a
list: copies and texts with a common part share many lists, so what is sent along goes to a few tasks, however many
there are. Candidates are verified on whole sets, after those
whose bitmaps of hashed shingles, at most a byte per shingle, already bound the overlap too low. Equal sets are one
node from the start.

Shuffled are the prefixes, packed per task and index partition, the bitmaps of candidates and the sets of what is
left. A shingle expected in more than HOT_ROWS prefixes is dealt over blocks of its holders, every pair of blocks
being one list; a document with many candidates is compared in groups of GROUP_ROWS.

Only A-Z are lower-cased; words are separated by the six ASCII white-space characters. A null or empty
text, or one without words, has an empty set and links with nothing. A text of fewer words than a shingle is
one shingle. Null ids are kept and count last as smallest id. Repeated rows are copies of each other. An
empty table gives an empty result. Only the id and the text are read, once: they are written with a row number,
and that table is read once per round and twice before. Shuffle files go with their query, and a written table goes as soon as
the next no longer needs it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import fuse
from tidemill.llm.common import by_bytes, fresh_name, give_back, numbered, small_batches, tidy, utf8
from tidemill.llm.components import connected_components
from tidemill.llm.hashing import mixed
from tidemill.llm.shingles import shingle_sets
from tidemill.session import discard, materialize, shuffles_freed

SKETCH_BITS = 20
SKETCH_CHUNKS = 64
LONGEST = 32  # shared shingles asked for, at most
PARTITION_ROWS = 500_000  # prefix shingles of one index partition, about
LEAST_PARTITIONS = 64
FLUSH_ROWS = 200_000
HOT_ROWS = 100_000
GROUP_ROWS = 128
LONG_LIST = 16  # holders of a list from which `near` looks beyond its commonest label
RING_TRIES = 2
LONG_CHECKED = 512  # holders of a list up to which it loses those that meet nobody before the last round
BLOCK_BYTES = 1 << 19
PAIR_BYTES = 1 << 22  # of bitmaps compared at once
PAIRS_HELD = 1 << 18
PAIR_ROWS = 1 << 14
FILTER_BYTES = 16 << 20
LAST_ID = (1 << 63) - 1
BROADCAST_NODES = 200_000  # candidates whose pairs, a few numbers each, are sent to all tasks


def overlap(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The least intersection of sets of these sizes with 100 * intersection >= 75 * union."""
    return -(-3 * (n_a + n_b) // 7)


def _source(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> tuple[DataFrame, list[DataFrame]]:
    """(row, id, text) of a written table, as every round has to find the same number on a row, and the table if written here."""
    known = [F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    if row_col is None:
        table = numbered(docs.select(*known), "row")
        return table.select("row", "id", "text"), [table]
    return docs.select(F.col(f"`{row_col}`").alias("row"), *known), []


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.sha256(shingles.tobytes()).digest()[:16]


def bitmap(shingles: np.ndarray) -> bytes:
    """A bit per value of a shingle's low hash bits, from four to eight times as many bits as shingles."""
    size = max(64, 4 << max(0, len(shingles) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_shared(n_a: int, bits_a: np.ndarray, n_b: int, bits_b: np.ndarray) -> int:
    """An upper bound of the overlap: each bit of one set that the other lacks is a shingle that the other lacks."""
    bits_a, bits_b = folded(bits_a, len(bits_b)), folded(bits_b, len(bits_a))
    only_a = int(np.bitwise_count(bits_a & ~bits_b).sum())
    only_b = int(np.bitwise_count(bits_b & ~bits_a).sum())
    return min(n_a - only_a, n_b - only_b)


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps, along the last axis, at no more than this width: upper halves are laid over lower ones."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def outline(bits: bytes) -> bytes:
    """The bitmap at a quarter of its width: one or two bits per shingle tell sets apart that share a passage only."""
    return folded(np.frombuffer(bits, np.uint8), max(8, len(bits) // 4)).tobytes()


class Bitmaps:
    """Bitmaps and set sizes of many rows, those of equal width together."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, bits: list[bytes]):
        order = np.argsort(rows, kind="stable")
        self.rows, self.sizes = rows[order], sizes[order]
        widths = np.array([len(b) for b in bits], np.int64)[order]
        self.width, self.place, self.tables = widths, np.zeros(len(rows), np.int64), {}
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            self.place[at] = np.arange(len(at))
            self.tables[width] = np.frombuffer(b"".join(bits[order[i]] for i in at), np.uint64).reshape(len(at), -1)

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bitmaps of each pair of rows leave room for the overlap that a link needs."""
        i, j = self.rows.searchsorted(a), self.rows.searchsorted(b)
        good = np.zeros(len(a), bool)
        classes = self.width[i] * (1 << 40) + self.width[j]
        for both in np.unique(classes).tolist():
            narrow = min(both >> 40, both & (1 << 40) - 1)
            left, right = (folded(self.tables[w], narrow // 8) for w in (both >> 40, both & (1 << 40) - 1))
            at = np.flatnonzero(classes == both)
            step = max(1, PAIR_BYTES // narrow)
            for k in range(0, len(at), step):
                some = at[k : k + step]
                x, y = left[self.place[i[some]]], right[self.place[j[some]]]
                n_x, n_y = self.sizes[i[some]], self.sizes[j[some]]
                only_x = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
                only_y = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
                good[some] = np.minimum(n_x - only_x, n_y - only_y) >= overlap(n_x, n_y)
        return good


class Marks:
    """Two-byte hashes and places of the shingles that many rows have in lists, all lists and not only those of one partition."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, marks: list[bytes]):
        order = np.argsort(rows, kind="stable")
        self.rows, self.sizes = rows[order], sizes[order]
        self.count = np.array([len(m) // 4 for m in marks], np.int64)[order]
        self.start = np.cumsum(self.count) - self.count
        self.mark, self.place = np.frombuffer(b"".join(marks[i] for i in order), np.uint16).reshape(-1, 2).astype(np.int64).T
        held = np.repeat(np.arange(len(rows)), self.count) << 16 | self.mark
        order = np.lexsort((self.place, held))
        self.held, self.held_place = held[order], self.place[order]

    def most_shared(self, a: np.ndarray, b: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Per pair of rows an upper bound of the listed shingles that both have at places that `_possible` accepts."""
        i, j = self.rows.searchsorted(a), self.rows.searchsorted(b)
        i, j = np.where(self.count[i] <= self.count[j], i, j), np.where(self.count[i] <= self.count[j], j, i)
        spare = asked - overlap(self.sizes[i], self.sizes[j])
        last_i, last_j = self.sizes[i] + spare, self.sizes[j] + spare
        out = np.zeros(len(a), np.int64)
        ends = np.cumsum(self.count[i])
        lo = 0
        while lo < len(a):  # blocks of bounded size
            hi = max(lo + 1, int(ends.searchsorted(ends[lo] - self.count[i[lo]] + PAIR_BYTES // 8, side="right")))
            n = self.count[i[lo:hi]]
            of = np.repeat(np.arange(lo, hi), n)
            at = np.arange(len(of)) + np.repeat(self.start[i[lo:hi]] - (np.cumsum(n) - n), n)
            near = self.place[at] <= last_i[of]
            of, at = of[near], at[near]
            key = j[of] << 16 | self.mark[at]
            met = np.minimum(self.held.searchsorted(key), len(self.held) - 1)  # of equal hashes of a row, the first place
            good = (self.held[met] == key) & (self.held_place[met] <= last_j[of])
            out[lo:hi] = np.bincount(of[good] - lo, minlength=hi - lo)
            lo = hi
        return out


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        texts = utf8(batch.column(2))
        for lo, hi in by_bytes([len(t) for t in texts], BLOCK_BYTES):
            yield batch.slice(lo, hi - lo), shingle_sets(texts[lo:hi], size)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; `_wide` tells how many by the length."""
    most = int(counts.max())
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def _wide(cell: bytes, count: int) -> np.ndarray:
    return np.frombuffer(cell, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(cell) // count]).astype(np.uint64)


def profiles(source: DataFrame, size: int) -> DataFrame:
    """(row, id, n, key, bits, outline) per document, and per task the counts of its shingles by hash bucket (chunk, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["row", "id", "n", "key", "bits", "outline", "part", "chunk", "counts"]
        for batch, sets in _sets(batches, size):
            tokens = np.concatenate(sets)
            counts += np.bincount((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
            bits = [bitmap(s) for s in sets]
            empty = [pa.nulls(len(sets), t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_key(s) for s in sets], pa.binary()),
                    pa.array(bits, pa.binary()),
                    pa.array([outline(b) for b in bits], pa.binary()),
                    *empty,
                ],
                names=names,
            )
        parts = [_narrow(p) for p in np.split(counts, SKETCH_CHUNKS)]
        none = [pa.nulls(SKETCH_CHUNKS, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array([part] * SKETCH_CHUNKS, pa.int32()), pa.array(range(SKETCH_CHUNKS), pa.int32()), pa.array(parts, pa.binary())],
            names=names,
        )

    schema = "row bigint, id bigint, n bigint, key binary, bits binary, outline binary, part int, chunk int, counts binary"
    return small_batches(source).mapInArrow(tidy(run), schema)


def sketch(found: DataFrame) -> np.ndarray:
    """The counts of all tasks, summed up in two steps; its size does not grow with the input."""
    step = (1 << SKETCH_BITS) // SKETCH_CHUNKS
    parts = found.where(F.col("chunk").isNotNull()).select("chunk", (F.col("part") % 64).alias("part"), "counts")

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.minimum(sum(_wide(c, step) for c in group["counts"]), np.uint64((1 << 32) - 1))
        return pd.DataFrame({"chunk": [key[0]], "part": [key[-1]], "counts": [_narrow(total)]})

    schema = "chunk int, part int, counts binary"
    first = parts.groupBy("chunk", "part").applyInPandas(add, schema)
    rows = first.groupBy("chunk").applyInPandas(add, schema).collect()
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in rows:
        out[r.chunk * step : (r.chunk + 1) * step] = _wide(bytes(r.counts), step)
    return out


def prefix(shingles: np.ndarray, counts: np.ndarray, usual: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The shingles of the adaptive prefix in order, their estimated holders, and the matches it asks for."""
    n = len(shingles)
    t = (3 * n + 3) // 4
    seen = counts[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.lexsort((shingles, seen))[: min(n, n - t + LONGEST)]
    holders = np.maximum(seen[order].astype(np.float64) - usual, 0)
    met = np.cumsum(holders)[n - t :]  # candidates met along the prefix that asks for 1, 2, ... matches
    met = met[: min(t, LONGEST)]
    asked = 1 + int(np.argmin(met + met[0] / np.arange(1, len(met) + 1)))
    cut = n - t + asked
    return shingles[order[:cut]], holders[:cut], asked


def index_rows(source: DataFrame, counts: np.ndarray, partitions: int, size: int) -> DataFrame:
    """Prefixes packed per task and index partition: (target, token, row, n, asked, place), arrays as bytes."""
    load = float(np.median(counts))
    usual = load + 3 * np.sqrt(load)

    def pack(tokens, rows, sizes, asked, places) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(tokens), np.concatenate(rows), np.concatenate(sizes), np.concatenate(asked), np.concatenate(places)]
        target = (mixed(columns[0]) % np.uint64(partitions)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        columns, target = [c[order] for c in columns], target[order]
        cuts = np.flatnonzero(np.diff(target, prepend=-1, append=-1))
        pieces = [(int(target[lo]), lo, hi) for lo, hi in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
        for k in range(0, len(pieces), 64):
            some = pieces[k : k + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0] for p in some], pa.int32()),
                    *(pa.array([c[lo:hi].tobytes() for _, lo, hi in some], pa.binary()) for c in columns),
                ],
                names=["target", "token", "row", "n", "asked", "place"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], [], []]
        waiting, met = 0, set()
        for batch, sets in _sets(batches, size):
            for row, shingles in zip(batch.column(0).to_pylist(), sets, strict=True):
                if not len(shingles):
                    continue
                key = _key(shingles)
                if key in met:  # a copy's set, which is indexed already
                    continue
                met.add(key)
                token, holders, asked = prefix(shingles, counts, usual)
                place = np.arange(1, len(token) + 1, dtype=np.uint32)
                if holders.max() > HOT_ROWS:
                    token, place = _dealt(token, holders, place, row)
                k = len(token)
                for column, values in zip(
                    held,
                    (token, np.full(k, row, np.int64), np.full(k, len(shingles), np.uint32), np.full(k, asked, np.uint8), place),
                    strict=True,
                ):
                    column.append(values)
                waiting += k
            if waiting > FLUSH_ROWS:
                yield from pack(*held)
                held, waiting, met = [[], [], [], [], []], 0, set()
        if waiting:
            yield from pack(*held)

    schema = "target int, token binary, row binary, n binary, asked binary, place binary"
    return small_batches(source).mapInArrow(tidy(run), schema)


def _dealt(token: np.ndarray, holders: np.ndarray, place: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Replace a shingle of very many holders by one per pair of blocks of holders that this row is in."""
    tokens, places = [], []
    for x, h, p in zip(token, holders, place, strict=True):
        blocks = int(-(-h // HOT_ROWS))
        if blocks <= 1:
            tokens.append(np.array([x], np.uint64))
        else:
            own = int(mixed(np.array([row], np.uint64))[0]) % blocks
            other = np.arange(blocks, dtype=np.uint64)
            low, high = np.minimum(other, np.uint64(own)), np.maximum(other, np.uint64(own))
            tokens.append(mixed(x + mixed(low * np.uint64(blocks) + high + np.uint64(1))))
        places.append(np.full(len(tokens[-1]), p, np.uint32))
    return np.concatenate(tokens), np.concatenate(places)


def _possible(sizes: np.ndarray, asked: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a shared shingle at these places can be among the first that a linked pair of these sizes shares."""
    n_i, n_j = sizes[i], sizes[j]
    fits = 4 * np.minimum(n_i, n_j) >= 3 * np.maximum(n_i, n_j)
    room = np.minimum(asked[i], asked[j]) + np.minimum(n_i - place[i], n_j - place[j])
    return fits & (room >= overlap(n_i, n_j))


class Lists:
    """The lists of holders of one index partition that have two holders or more, those with fewest rarer shingles first."""

    def __init__(self, token, row, n, asked, place):
        order = np.lexsort((row, place, token))
        token = token[order]
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.empty(0, np.int64)
        length = np.diff(np.append(edge, len(token)))
        live = np.repeat(length > 1, length)
        self.token = token[live]
        self.row, self.n, self.asked, self.place = (
            c[order][live].astype(np.int64) for c in (row, n, asked, place)
        )
        self.length = length[length > 1]
        self.start = np.cumsum(self.length) - self.length

    def counted(self, i: np.ndarray, j: np.ndarray, whole: bool = False) -> tuple[np.ndarray, ...]:
        """(a, b, shared, asked) per pair of rows, from pairs of positions."""
        a, b = np.minimum(self.row[i], self.row[j]), np.maximum(self.row[i], self.row[j])
        asked = np.minimum(self.asked[i], self.asked[j])
        if whole:  # those of the overlap that lie beyond a prefix are few; half, as a pair is not met in lists where others come first
            beyond = [(3 * self.n[k] + 3) // 4 - self.asked[k] for k in (i, j)]
            asked = np.maximum(asked, (overlap(self.n[i], self.n[j]) - np.maximum(*beyond) + 1) // 2)
        order = np.lexsort((b, a))
        a, b, asked = a[order], b[order], asked[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
        return a[first], b[first], np.diff(np.append(first, len(a))), asked[first]

    def star(self) -> tuple[np.ndarray, ...]:
        """Each holder with the first of its list; a pair missed here, as lists may start apart, is left to `between`.

        Of near copies the first has the fewest shingles of its own, and so links with more of them than any other.
        """
        i = np.repeat(self.start, self.length)
        j = np.arange(len(self.row))
        n_i, n_j = self.n[i], self.n[j]
        good = (self.row[i] != self.row[j]) & (4 * np.minimum(n_i, n_j) >= 3 * np.maximum(n_i, n_j))
        return self.counted(i[good], j[good], whole=True)

    def near(self, label: np.ndarray, salt: int, tries: int = 4) -> tuple[np.ndarray, ...]:
        """Each holder outside the commonest label of its list with a few holders of that label, which hashes choose.

        In a long list where no label has most holders, each is compared with the next few of the list, whatever their label:
        a group of near copies closes however the holder that `star` chose happens to differ. The same few are chosen wherever a
        holder meets them. Pairs missed here are left to `between`.
        """
        if not len(self.row):
            return self.counted(np.empty(0, np.int64), np.empty(0, np.int64))
        owner = np.repeat(np.arange(len(self.length)), self.length)
        order = np.lexsort((label, owner))
        change = (np.diff(label[order], prepend=label[order[0]] - 1) != 0) | (np.diff(owner[order], prepend=-1) != 0)
        run = np.flatnonzero(change)
        size, run_owner, run_label = np.diff(np.append(run, len(order))), owner[order[run]], label[order[run]]
        best = np.lexsort((run_label, -size, run_owner))
        best = best[np.diff(run_owner[best], prepend=-1) != 0]
        main = label == run_label[best][owner]
        ring = np.lexsort((mixed(self.row.astype(np.uint64) + np.uint64(salt)), owner))
        held = ring[main[ring]]  # by list, then by hash
        count = np.bincount(owner[held], minlength=len(self.length))
        start = np.cumsum(count) - count
        ahead = np.empty(len(ring), np.int64)
        ahead[ring] = np.cumsum(main[ring])
        out = np.flatnonzero(~main)
        k = np.arange(tries)
        at = start[owner[out], None] + (ahead[out, None] - start[owner[out], None] + k) % count[owner[out], None]
        good = k < count[owner[out], None]
        i, j = np.broadcast_to(out[:, None], at.shape)[good], held[at[good]]
        open_list = (self.length >= LONG_LIST) & (2 * count < self.length)
        of = np.flatnonzero(open_list[owner])  # places in the ring, which has the lists in the same order
        ahead = self.start[owner[of], None] + (of[:, None] - self.start[owner[of], None] + 1 + np.arange(RING_TRIES)) % self.length[owner[of], None]
        i, j = np.append(i, np.repeat(ring[of], RING_TRIES)), np.append(j, ring[ahead.ravel()])
        pair = np.unique(np.minimum(i, j) * len(ring) + np.maximum(i, j))  # once in a list, whichever way it is met
        i, j = np.divmod(pair, len(ring))
        good = label[i] != label[j]
        i, j = i[good], j[good]
        good = 4 * np.minimum(self.n[i], self.n[j]) >= 3 * np.maximum(self.n[i], self.n[j])
        return self.counted(i[good], j[good], whole=True)

    def possible(self, label: np.ndarray, longest: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions of a list, of lists of up to `longest`, whose labels differ and whose places let them link, in blocks."""
        for length in np.unique(self.length[self.length <= (longest or np.inf)]).tolist():
            starts = self.start[self.length == length]
            rows_at_once = max(1, min(length, PAIRS_HELD // length))
            for lo in range(0, length, rows_at_once):
                left, right = np.meshgrid(np.arange(lo, min(length, lo + rows_at_once)), np.arange(length), indexing="ij")
                upper = left < right
                left, right = left[upper], right[upper]
                lists = max(1, PAIRS_HELD // max(1, len(left)))
                for k in range(0, len(starts), lists):
                    at = starts[k : k + lists, None]
                    i, j = (at + left).ravel(), (at + right).ravel()
                    good = np.flatnonzero(label[i] != label[j])
                    i, j = i[good], j[good]
                    good = np.flatnonzero(_possible(self.n, self.asked, self.place, i, j) & (self.row[i] != self.row[j]))
                    yield i[good], j[good]

    def between(self, label: np.ndarray, bitmaps: Bitmaps, marks: Marks) -> tuple[np.ndarray, ...]:
        """Each holder with every other of its list that has another label, as far as bitmaps and marks let them link.

        Pairs are made and screened in blocks of bounded size.
        """
        done: list[tuple[np.ndarray, ...]] = []
        found_i, found_j, waiting = [], [], 0

        def screen() -> None:
            pairs = self.counted(np.concatenate(found_i), np.concatenate(found_j))
            good = bitmaps.may_link(pairs[0], pairs[1])
            pairs = tuple(column[good] for column in pairs)
            good = marks.most_shared(pairs[0], pairs[1], pairs[3]) >= pairs[3]
            done.append(tuple(column[good] for column in pairs))

        for i, j in self.possible(label):
            found_i.append(i)
            found_j.append(j)
            waiting += len(i)
            if waiting > PAIRS_HELD:
                screen()
                found_i, found_j, waiting = [], [], 0
        if found_i:
            screen()
        if not done:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        a, b, shared, asked = (np.concatenate(c) for c in zip(*done, strict=True))
        order = np.lexsort((b, a))
        a, b, shared, asked = (c[order] for c in (a, b, shared, asked))
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.empty(0, np.int64)
        total = np.add.reduceat(shared, first) if len(a) else shared  # blocks have met some pairs more than once
        return a[first], b[first], total, asked[first]

    def mixed(self, label: np.ndarray) -> np.ndarray:
        """Which positions belong to lists of two labels and more."""
        if not len(label):
            return np.empty(0, bool)
        low, high = np.minimum.reduceat(label, self.start), np.maximum.reduceat(label, self.start)
        return np.repeat(low != high, self.length)

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in PACKED.items()}


    def may_meet(self, label: np.ndarray) -> np.ndarray:
        """Which positions have another one in their list that `between` would pair them with; those of very long lists pass."""
        out = np.repeat(self.length > LONG_CHECKED, self.length)
        for i, j in self.possible(label, LONG_CHECKED):
            out[i] = out[j] = True
        return out

    def only(self, kept: np.ndarray) -> Lists:
        """The lists of these positions."""
        return Lists(self.token[kept], self.row[kept], self.n[kept], self.asked[kept], self.place[kept])

    def leaders(self) -> np.ndarray:
        """Per position the smallest hash of a holder of its list."""
        return np.repeat(np.minimum.reduceat(mixed(self.row.astype(np.uint64)), self.start), self.length)


PACKED = {"token": np.uint64, "row": np.int64, "n": np.uint32, "asked": np.uint8, "place": np.uint32}
LISTS = "target int, token binary, row binary, n binary, asked binary, place binary"
PAIRS = "a bigint, b bigint, shared bigint, asked bigint"
PACKED_PAIRS = ("pair_a", "pair_b", "pair_shared", "pair_asked")


def _unpacked(group: pd.DataFrame) -> Lists:
    return Lists(*(np.concatenate([np.frombuffer(b, kind) for b in group[name]] or [np.empty(0, kind)]) for name, kind in PACKED.items()))


def first_round(index: DataFrame) -> DataFrame:
    """Per index partition its lists of two and more holders and the pairs of the first comparison, all packed."""

    def reduce(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        give_back()
        lists = _unpacked(group)
        pairs = dict(zip(PACKED_PAIRS, (column.astype(np.int64).tobytes() for column in lists.star()), strict=True))
        return pd.DataFrame({"target": [key[0]], **{k: [v] for k, v in (lists.packed() | pairs).items()}})

    schema = ", ".join([LISTS, *(f"{name} binary" for name in PACKED_PAIRS)])
    return index.groupBy("target").applyInPandas(reduce, schema)


def unpacked_pairs(live: DataFrame) -> DataFrame:
    """The pairs of `first_round` as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                columns = [np.frombuffer(column[i].as_py(), np.int64) for column in batch.columns]
                for k in range(0, len(columns[0]), PAIR_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k : k + PAIR_ROWS]) for c in columns], names=["a", "b", "shared", "asked"])

    return live.select(*PACKED_PAIRS).mapInArrow(tidy(run), PAIRS)


def rows_of(live: DataFrame) -> DataFrame:
    """(target, row) of the holders in each index partition's lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for target, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                distinct = np.unique(np.frombuffer(rows.as_py(), np.int64))
                for k in range(0, len(distinct), PAIR_ROWS):
                    some = distinct[k : k + PAIR_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), target, np.int32)), pa.array(some)], names=["target", "row"])

    return live.select("target", "row").mapInArrow(tidy(run), "target int, row bigint")


def marks_of(lists: DataFrame) -> DataFrame:
    """(row, marks) per holder: hashes and places, for `Marks`, of its shingles in the lists of all partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in zip(*batch.columns, strict=True):
                token, rows, place = (np.frombuffer(c.as_py(), PACKED[name]) for c, name in zip(cells, ("token", "row", "place"), strict=True))
                marks = np.column_stack([mixed(token) >> np.uint64(48), np.minimum(place, 0xFFFF)]).astype(np.uint16)
                marks = marks[np.argsort(rows, kind="stable")]
                distinct, count = np.unique(rows, return_counts=True)
                ends = np.append(0, np.cumsum(count)).tolist()
                for k in range(0, len(distinct), PAIR_ROWS):
                    some = distinct[k : k + PAIR_ROWS]
                    packed = [marks[ends[i] : ends[i + 1]].tobytes() for i in range(k, k + len(some))]
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(packed, pa.binary())], names=["row", "marks"])

    parts = lists.select("token", "row", "place").mapInArrow(tidy(run), "row bigint, marks binary")
    return parts.groupBy("row").agg(F.collect_list("marks").alias("marks"))


def mixed_lists(live: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose holders' labels (row, label) differ, with the label of each; once alike, they stay alike.

    A row without a label is a component of its own.
    """
    held = live.select("target", *PACKED)
    known = rows_of(held).join(labels, "row").select("target", "row", "label")

    def reduce(key: tuple, group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        give_back()
        lists = _unpacked(group)
        label = lists.row.copy()
        if len(known) and len(label):
            known = known.sort_values("row")
            rows = known["row"].to_numpy(np.int64)
            at = np.minimum(rows.searchsorted(lists.row), len(rows) - 1)
            label = np.where(rows[at] == lists.row, known["label"].to_numpy(np.int64)[at], lists.row)
        kept = lists.mixed(label)
        if not kept.any():
            return pd.DataFrame({name: [] for name in ("target", *PACKED, "label")})
        cells = {name: getattr(lists, name)[kept].astype(kind) for name, kind in PACKED.items()} | {"label": label[kept]}
        return pd.DataFrame({"target": [key[0]], **{name: [cell.tobytes()] for name, cell in cells.items()}})

    return held.groupBy("target").cogroup(known.groupBy("target")).applyInPandas(reduce, f"{LISTS}, label binary")


def _labelled(group: pd.DataFrame) -> tuple[Lists, np.ndarray]:
    """The lists of one or more partitions of `mixed_lists`, and the label at each place; a row has the same everywhere."""
    lists = _unpacked(group)
    rows, first = np.unique(np.concatenate([np.frombuffer(b, np.int64) for b in group["row"]]), return_index=True)
    labels = np.concatenate([np.frombuffer(b, np.int64) for b in group["label"]])[first]
    return lists, labels[rows.searchsorted(lists.row)]


def _pair_frame(pairs: tuple[np.ndarray, ...]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(["a", "b", "shared", "asked"], pairs, strict=True)))


def near_pairs(mixed: DataFrame, salt: int) -> DataFrame:
    """Pairs of holders whose labels differ, a few of each holder's."""

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        lists, label = _labelled(group)
        return _pair_frame(lists.near(label, salt))

    return mixed.groupBy("target").applyInPandas(reduce, PAIRS)


def led_lists(live: DataFrame, partitions: int, groups: int) -> DataFrame:
    """The lists and labels of `mixed_lists` (of so many partitions) as the last round needs them: without holders that meet nobody
    there, and dealt over `groups` by their leaders.

    What is sent along with a row goes to each group that has it. Dealt by shingles, a row would be in as many groups as it
    has shingles in lists, and so in the more groups the larger the table. A leader of more than PARTITION_ROWS is dealt further.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lists, label = _labelled(batch.slice(i, 1).to_pandas())
                rows, first = np.unique(lists.row, return_index=True)
                lists, label = lists.only(lists.may_meet(label)), label[first]
                if not len(lists.row):
                    continue
                label = label[rows.searchsorted(lists.row)]
                leader = lists.leaders()
                _, of, count = np.unique(leader, return_inverse=True, return_counts=True)
                pieces = -(-count[of] * partitions // PARTITION_ROWS)  # a shingle's partition is chance, so each has its share of a leader
                group = mixed(leader + lists.token % pieces.astype(np.uint64)) % np.uint64(groups)
                order = np.argsort(group, kind="stable")
                cuts = np.append(np.flatnonzero(np.diff(group[order].astype(np.int64), prepend=-1)), len(order))
                cells = {name: getattr(lists, name)[order].astype(kind) for name, kind in PACKED.items()} | {"label": label[order]}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group[order][cuts[:-1]].astype(np.int32)),
                        *(pa.array([cell[lo:hi].tobytes() for lo, hi in pairwise(cuts.tolist())], pa.binary()) for cell in cells.values()),
                    ],
                    names=["target", *cells],
                )

    return live.select("target", *PACKED, "label").mapInArrow(tidy(run), f"{LISTS}, label binary")


def all_pairs(mixed: DataFrame, found: DataFrame, groups: int) -> DataFrame:
    """All pairs of holders whose labels differ and whose outlines, in `profiles`, and marks let them link.

    A pair whose shingles in all lists are too few for it is not made, so that what a large group of copies shares by
    chance makes no rows. The lists are those of `led_lists`, which keep a pair, and the outlines sent, in few groups.
    """
    mixed = mixed.withColumn("target", (F.col("target") % groups).cast("int"))
    known = found.where(F.col("row").isNotNull()).select("row", "n", "outline").join(marks_of(mixed), "row")
    known = rows_of(mixed).distinct().join(known, "row").select("target", "row", "n", "outline", "marks")

    def reduce(key: tuple, group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return _pair_frame(tuple(np.empty(0, np.int64) for _ in range(4)))
        lists, label = _labelled(group)
        bitmaps = Bitmaps(known["row"].to_numpy(np.int64), known["n"].to_numpy(np.int64), known["outline"].tolist())
        marks = Marks(known["row"].to_numpy(np.int64), known["n"].to_numpy(np.int64), [b"".join(m) for m in known["marks"]])
        return _pair_frame(lists.between(label, bitmaps, marks))

    return mixed.groupBy("target").cogroup(known.groupBy("target")).applyInPandas(reduce, PAIRS)


def enough(pairs: DataFrame) -> DataFrame:
    """The pairs that share as many prefix shingles as they have to."""
    summed = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("asked").alias("asked"))
    return summed.where("shared >= asked").select("a", "b")


def compared(values: DataFrame, pairs: DataFrame, total: int, shared: Callable[[int, bytes, int, bytes], int]) -> DataFrame:
    """The pairs that link by what `shared` makes of the values (row, n, value) of both."""
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("groups"))
    members = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part"), F.col("b").alias("row"))
    heads = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.col("a").alias("row"))
    asked = members.unionByName(heads)
    if total <= BROADCAST_NODES:  # then a value is shuffled once, to its comparison; beyond, also to meet its pairs
        asked = F.broadcast(asked)
    met = values.join(asked, "row").select("a", "part", "row", "n", "value").repartition("a", "part")
    met = met.sortWithinPartitions("a", "part", F.col("row") != F.col("a"))  # a group's head, then its members

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, n_head, value_head = None, 0, b""
        for batch in batches:
            linked_a, linked_b = [], []
            values = batch.column(4)
            for i, (a, row, n) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True)):
                if row == a:
                    head, n_head, value_head = a, n, values[i].as_py()
                elif a == head:
                    both = shared(n_head, value_head, n, values[i].as_py())
                    if n and 100 * both >= 75 * (n_head + n - both):
                        linked_a.append(a)
                        linked_b.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(linked_a, pa.int64()), pa.array(linked_b, pa.int64())], names=["a", "b"])

    return met.mapInArrow(tidy(run), "a bigint, b bigint")


def screened(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that may link as far as the bitmaps of `profiles` tell; no pair that links is lost."""
    pairs = materialize(pairs, "candidates")

    def shared(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes) -> int:
        return most_shared(n_a, np.frombuffer(bits_a, np.uint8), n_b, np.frombuffer(bits_b, np.uint8))

    values = found.where(F.col("row").isNotNull()).select("row", "n", F.col("bits").alias("value"))
    return compared(values, pairs, pairs.count(), shared)


def verified(source: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The pairs whose sets link."""
    pairs = materialize(pairs, "pairs")
    nodes = materialize(pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct(), "nodes")
    total = max(nodes.count(), pairs.count())
    blobs = None
    if total * 1.3 < FILTER_BYTES:  # keeps other documents' sets where they are; beyond, the join alone does it
        buckets = max(1, total // 200_000)

        def make(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"bucket": [key[0]], "filter": [fuse.build(group["row"].to_numpy(np.uint64))]})

        found = nodes.withColumn("bucket", F.col("row") % buckets).groupBy("bucket").applyInPandas(make, "bucket bigint, filter binary")
        blobs = {r.bucket: bytes(r.filter) for r in found.collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if blobs is not None:
                    rows = batch.column(0).to_numpy()
                    keep = np.zeros(len(rows), bool)
                    for bucket, blob in blobs.items():
                        at = np.flatnonzero(rows % buckets == bucket)
                        keep[at] = fuse.contains(blob, rows[at].astype(np.uint64))
                    batch = batch.filter(pa.array(keep))
                if batch.num_rows:
                    yield batch

        for batch, sets in _sets(wanted(), size):
            lengths = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lengths, pa.array([s.tobytes() for s in sets], pa.binary())], names=["row", "n", "value"]
            )

    def shared(n_a: int, set_a: bytes, n_b: int, set_b: bytes) -> int:
        a, b = np.frombuffer(set_a, np.uint64), np.frombuffer(set_b, np.uint64)
        if not n_a or not n_b:
            return 0
        return int(np.count_nonzero(a[np.minimum(a.searchsorted(b), n_a - 1)] == b))

    sets = small_batches(source).mapInArrow(tidy(run), "row bigint, n bigint, value binary")
    return compared(sets, pairs, total, shared)


def _components(docs: DataFrame, size: int, id_col: str, text_col: str, row_col: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, id, n, key) of the documents, (key, node, low, first) of equal sets, and (node, label) of those that link with others."""
    source, written = _source(docs, id_col, text_col, row_col)
    found = materialize(profiles(source, size), "profiles")
    rows = materialize(found.where(F.col("row").isNotNull()).select("row", "id", "n", "key"), "rows")
    total = rows.agg(F.sum("n")).first()[0] or 0
    partitions = max(LEAST_PARTITIONS, -(-total // (4 * PARTITION_ROWS)))

    live = materialize(first_round(index_rows(source, sketch(found), partitions, size)), "lists")
    classes = rows.where("n > 0").groupBy("key").agg(
        F.min("row").alias("node"), F.min("id").alias("low"), F.min(F.struct(F.coalesce("id", F.lit(LAST_ID)).alias("id"), "row")).alias("first")
    )
    node_of = materialize(rows.where("n > 0").join(classes.select("key", "node"), "key").select("row", "node"), "nodes")

    def links(pairs: DataFrame) -> DataFrame:
        """Verified pairs as edges between the first rows of equal sets."""
        good = verified(source, pairs, size)
        left = good.join(node_of.select(F.col("row").alias("a"), F.col("node").alias("x")), "a")
        both = left.join(node_of.select(F.col("row").alias("b"), F.col("node").alias("y")), "b")
        return both.select(F.col("x").alias("a"), F.col("y").alias("b"))

    found_links = materialize(links(screened(found, enough(unpacked_pairs(live)))), "links")
    for salt in (1, 2, None):  # a few of each holder's pairs, twice, so that groups of copies close; then all that are left
        labels = connected_components(found_links)
        label_of = node_of.join(labels, "node", "left").select("row", F.coalesce("label", "node").alias("label"))
        before, live = live, materialize(mixed_lists(live, label_of.where(F.col("row") != F.col("label"))), "mixed")
        discard(before)
        if salt is None:
            groups = max(16, partitions // 4)
            before, live = live, materialize(led_lists(live, partitions, groups), "led")
            discard(before)
        pairs = all_pairs(live, found, groups) if salt is None else near_pairs(live, salt)
        before, found_links = found_links, materialize(found_links.unionByName(links(screened(found, enough(pairs)))), "links")
        discard(before)
    labels = connected_components(found_links)
    discard(live, found, found_links, node_of, *written)
    return rows, classes, labels


def jaccard_groups(
    docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """(row, id, n_shingles, component_id, first_row) per row of `docs`: the component's smallest id and the row that has it.

    Of rows that share it, that with the smallest hash of its set counts, and of equal sets the first read.

    `row_col` names the row numbers of a written table; without it the rows are numbered and written here.
    """
    with shuffles_freed(docs.sparkSession):
        rows, classes, labels = _components(docs, size, id_col, text_col, row_col)
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = F.min(F.struct("first.id", "key", "first.row")).alias("first_of_all")
    lowest = named.groupBy("label").agg(F.min("low").alias("component_id"), first)
    named = named.join(lowest, "label").select("key", "component_id", F.col("first_of_all.row").alias("first_row"))
    return rows.join(named, "key", "left").select(
        "row",
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("first_row")).otherwise(F.col("row")).alias("first_row"),
    )


def drop_near_copies(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with one document per group, that with the smallest id."""
    row = fresh_name(docs, "row")
    docs = numbered(docs, row)
    gone = jaccard_groups(docs, size, id_col, text_col, row).where("row != first_row").select(F.col("row").alias(row))
    return docs.join(materialize(gone, "gone"), row, "left_anti").drop(row)  # written, so that the join knows its size
