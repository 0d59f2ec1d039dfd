"""Spelling variants: words one edit apart, found by comparing tiles of words on prefix and suffix.

Two words differ by exactly one inserted, deleted or replaced code point if and only if the length of their common
prefix plus that of their common suffix reaches the longer length m less one. One of the two is then m // 2 long at
least, so words are tiled by (m, first m // 2 code points) and (m, last m // 2 code points), each word once as the
longer and once as the shorter of a pair. Within a tile all words are compared densely: as rows of padded code-point
matrices, one aligned left for the prefix and one aligned right for the suffix, a block of pairs at a time. A pair
counts in its prefix tile, and in its suffix tile only where the prefix is too short for the other. A tile of more than
TILE_ROWS words is dealt over blocks, and every pair of blocks is compared as a tile of its own.

A tile gives one row per word, with the number of its near words and the best of them, not the pairs. Nothing is
compared on a sample or up to a cap.

Words are maximal runs of letters, of which only A-Z are lower-cased. A null or empty text has none. A repeated row
counts its words again. Ties between near words of equal counts go to the word that is smaller in code-point order. An
empty table, or one without words that are long and frequent enough, gives no rows. Texts of any length are read
whole, a piece at a time. Only the id and the text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import small_batches
from tidemill.session import materialize

LETTERS = "[A-Za-zÀ-ÿ]"
PIECE = 1 << 20  # code points of a text that are searched at once, about
WORDS_HELD = 200_000  # different words a task counts before it hands them on
TILE_ROWS = 2_048
TASK_ROWS = 100_000  # rows of tiles that are compared by one task, about
CELLS = 1 << 18  # pairs compared at once, about

NEAR = "word string, n_near bigint, best_n bigint, best string"


def pieces(text: str, run: re.Pattern) -> Iterator[list[str]]:
    """The runs of a text, of a piece of it at a time; no run crosses a piece's end."""
    at, letter = 0, re.compile(f"{LETTERS}*")
    while len(text) - at > PIECE:
        end = letter.match(text, at + PIECE).end()
        yield run.findall(text, at, end)
        at = end
    yield run.findall(text, at)


def count_words(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, misspell_every: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n) of all words that are long and frequent enough.

    With `misspell_every`, one code point is deleted first from about one in so many (document, word), as a checksum
    of both chooses, so that it can be measured how many misspellings are found; documents without an id are left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(f"{LETTERS}{{{least_length},}}")  # shorter runs come to nothing
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = [(word, n) for word, n in held.items() if n and len(word) >= least_length]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["word", "n"])

        for batch in batches:
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py()
                if not text:
                    continue
                before = zlib.crc32(f"{doc_id}:".encode())
                for found in pieces(text.encode().lower().decode(), letters):  # of bytes, only A-Z are lower-cased
                    held.update(found)
                    if misspell_every and doc_id is not None:
                        for word in [w for w in set(found) if not zlib.crc32(w.encode(), before) % misspell_every]:
                            n, k = found.count(word), zlib.crc32(word.encode(), before) % len(word)
                            held[word] -= n
                            held[word[:k] + word[k + 1 :]] += n
                    if len(held) > WORDS_HELD:
                        yield out()
        yield out()

    known = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = small_batches(known).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def tile_rows(words: DataFrame) -> DataFrame:
    """(m, head, tile, left, right, own, word, n): the words of every tile, large tiles as pairs of blocks."""
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1))
    half = F.floor(F.col("m") / 2).cast("int")
    side = F.explode(F.array(F.struct(F.lit(True).alias("head"), F.expr("left(word, half)").alias("key")), F.struct(F.lit(False).alias("head"), F.expr("right(word, half)").alias("key"))))
    rows = words.withColumn("m", longer).withColumn("half", half).withColumn("side", side)
    rows = rows.select("m", "side.head", F.xxhash64("m", "side.head", "side.key").alias("tile"), "word", "n")
    sizes = rows.groupBy("tile").agg(F.count("*").alias("held")).where(F.col("held") > TILE_ROWS)
    large = materialize(sizes.select("tile", F.ceil(F.col("held") / TILE_ROWS).cast("int").alias("blocks")), "large")
    rows = rows.join(large, "tile", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.select("m", "head", "tile", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "word", "n")


class Matrix:
    """Words of lengths m and m - 1 as columns of code points, aligned left and right."""

    def __init__(self, words: list[str], m: int):
        self.m = m
        longer = np.array([len(w) == m for w in words])
        left, right = np.zeros((2, len(words), m), np.uint32)
        for length, rows in ((m, np.flatnonzero(longer)), (m - 1, np.flatnonzero(~longer))):
            codes = np.frombuffer("".join(words[i] for i in rows).encode("utf-32-le"), "<u4").reshape(len(rows), length)
            left[rows, :length] = codes
            right[rows, m - length :] = codes
        kind = np.uint8 if not left.size or left.max() < 256 else np.uint32
        self.left, self.right = (x.T.astype(kind, order="C") for x in (left, right[:, ::-1]))

    def shared(self, columns: np.ndarray, a: slice, b: slice, first: int = 0) -> np.ndarray:
        """How many leading columns are equal, for each word of `a` with each of `b`; the first ones are known to be."""
        alive = np.ones((a.stop - a.start, b.stop - b.start), bool)
        count = np.full(alive.shape, first, np.uint8 if self.m < 128 else np.uint32)  # sums of two are taken
        for column in columns[first:]:
            alive &= column[a, None] == column[None, b]
            if not alive.any():
                break
            count += alive
        return count

    def near(self, a: slice, b: slice, head: bool) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of words of `a` and `b` that are one edit apart and count in a tile of this side."""
        half = self.m // 2
        own, other = (self.left, self.right) if head else (self.right, self.left)
        same = all((column[a] == column[a.start]).all() and (column[b] == column[a.start]).all() for column in own[:half])
        known = self.shared(own, a, b, half if same else 0)  # words of other keys come here only if hashes collide
        rest = self.shared(other[: self.m - 1 - half if head else half], a, b)
        near = known + rest >= self.m - 1
        if not head:
            near &= rest < half
        if not same:
            near &= known >= half
        i, j = np.nonzero(near)
        return a.start + i, b.start + j


def tile_pairs(matrix: Matrix, head: bool, runs: list[tuple[slice, slice]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs between two ranges of rows each, a block of bounded size at a time."""
    for a, b in runs:
        height = max(1, CELLS // max(1, b.stop - b.start))
        for low in range(a.start, a.stop, height):
            yield matrix.near(slice(low, min(a.stop, low + height)), b, head)


def near_of_tiles(group: pd.DataFrame) -> pd.DataFrame:
    """Per word of some tiles, the number of its near words there and the best of them."""
    found_a, found_b = [], []
    group["short"] = group["word"].str.len() < group["m"]
    group = group.sort_values(["m", "head", "tile", "left", "right", "own", "short"], ignore_index=True)
    words, n = group["word"].tolist(), group["n"].to_numpy(np.int64)
    keys = np.stack([group[c].to_numpy(np.int64) for c in ("m", "head", "tile", "left", "right", "own", "short")])
    change = np.diff(keys, axis=1, prepend=keys[:, :1] - 1) != 0
    sides, tiles, parts = (np.append(np.flatnonzero(change[:k].any(axis=0)), len(group)).tolist() for k in (2, 5, 7))
    ends = dict(zip(parts, parts[1:], strict=False))
    at = 0
    for low, high in zip(sides, sides[1:], strict=False):
        m, head = int(keys[0, low]), bool(keys[1, low])
        matrix = None
        while tiles[at] < high:
            start, end = tiles[at], tiles[at + 1]
            at += 1
            if end - start < 2:
                continue
            matrix = matrix or Matrix(words[low:high], m)
            cuts = [start]  # of the parts: by block, the longer words first
            while cuts[-1] < end:
                cuts.append(ends[cuts[-1]])
            ranges = [slice(a - low, b - low) for a, b in zip(cuts, cuts[1:], strict=False)]
            marks = [(int(keys[5, c]), bool(keys[6, c])) for c in cuts[:-1]]
            one_block = keys[3, start] == keys[4, start]
            runs = [
                (ranges[x], ranges[y])
                for x in range(len(ranges))
                for y in range(x, len(ranges))
                if not (marks[x][1] and marks[y][1]) and (one_block or marks[x][0] != marks[y][0])
            ]
            for a, b in tile_pairs(matrix, head, runs):
                once = a < b
                found_a.append(low + a[once])
                found_b.append(low + b[once])
    a = np.concatenate([*found_a, *found_b, np.empty(0, np.int64)])
    b = np.concatenate([*found_b, *found_a, np.empty(0, np.int64)])
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    names = sorted({words[i] for i in used.tolist()})  # in code-point order
    rank = {word: k for k, word in enumerate(names)}
    place = np.array([rank[words[i]] for i in used.tolist()], np.int64)[place]
    at_a, at_b = place[: len(a)], place[len(a) :]
    order = np.lexsort((at_b, -n[b], at_a))
    first = order[np.diff(at_a[order], prepend=-1) != 0]
    counts = np.bincount(at_a, minlength=len(names))
    return pd.DataFrame(
        {
            "word": pd.Series([names[i] for i in at_a[first].tolist()], dtype=object),
            "n_near": counts[at_a[first]],
            "best_n": n[b[first]],
            "best": pd.Series([names[i] for i in at_b[first].tolist()], dtype=object),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of a written table (word, n) that have a near word."""
    total = words.count()
    tasks = max(8, -(-4 * total // TASK_ROWS))
    rows = tile_rows(words).withColumn("task", F.pmod(F.xxhash64("tile", "left", "right"), F.lit(tasks)))
    found = rows.groupBy("task").applyInPandas(near_of_tiles, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following the forms (word, form) of a written table ends.

    Each round doubles the steps taken. A form has at least twice its word's count, so there is no circle, and the
    rounds are the logarithm of a logarithm of the largest count.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        beyond = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(reached.join(beyond, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def group_spellings(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each of the distinct words (word, n).

    A word's form is its commonest near word, if that is at least `ratio` times (two or more) as common as the word.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "words")
    common = F.col("best_n") >= ratio * F.col("n")
    formed = words.join(near_words(words), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("best")).alias("form"),
        F.when(common, F.col("best_n")).alias("form_n"),
    )
    formed = materialize(formed, "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
