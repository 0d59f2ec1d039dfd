"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Features of the line and of its two neighbours give each label a score, and a
matrix scores neighbouring labels; forward-backward passes give the probability that a line is good. The
mean over a document's lines, weighted by their length, goes through a fitted logistic curve and is the
document's quality. Features are shares of characters and words, so they read neither language, source,
id nor label.

The model is fitted by gradient steps on the driver from a bounded sample of labelled rows (`max_docs`
documents of at most `max_lines` lines); lines start with their document's label. It has a few dozen
numbers and is shipped with the scoring tasks. Scoring reads every line of every text, block by block.

Null and empty texts are one empty line and get the score of a document whose lines are all like that.
Labels of an id are averaged, and rows without a label are not used. Repeated rows get a row each. Without
labels of both kinds every document scores the share of good ones, or 0.5 without any. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import by_bytes, fresh_name, small_batches, tidy, utf8
from tidemill.llm.hashing import range_hashes

BLOCK_BYTES = 1 << 19
# Bytes by class: 0 other, 1 lower-case or part of a letter beyond ASCII, 2 upper-case, 3 digit, 4 sentence mark,
# 5 symbol, 6 white space.
CLASS = np.zeros(256, np.uint8)
CLASS[97:123] = CLASS[128:] = 1
CLASS[65:91] = 2
CLASS[48:58] = 3
CLASS[list(b".,;:'\"-()")] = 4
CLASS[list(b"!?#$%&*+/<=>@[\\]^_`{|}~")] = 5
CLASS[list(b" \t\r\n\x0b\x0c")] = 6
FEATURES = 14


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features per line, the line's length in bytes, and how many lines each text has (1 at least)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n_lines = np.array([t.count(b"\n") + 1 for t in texts])
    length = ends - starts
    kind = CLASS[data]
    size = np.maximum(length, 1)

    def share(what: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(what, dtype=np.int32)])
        return (total[ends] - total[starts]) / size

    word = kind != 6
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    line = np.searchsorted(ends, first)
    words = np.bincount(line, minlength=len(ends))
    h = range_hashes(data, first, last)
    again = np.zeros(len(first), bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    different = np.bincount(_first_of(line, h), minlength=len(ends))
    ending = kind[last - 1] if len(last) else np.empty(0, np.uint8)
    per_word = np.maximum(words, 1)
    # Lines that repeat an earlier line of the same text.
    owner = np.repeat(np.arange(len(texts)), n_lines)
    lh = range_hashes(data, starts, ends)
    seen = np.ones(len(ends), bool)
    order = np.lexsort((np.arange(len(ends)), lh, owner))
    same = (lh[order][1:] == lh[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    seen[order[0]] = False
    seen[order[1:]] = same
    features = np.stack(
        [
            np.log1p(length) / 8,
            share(kind == 1),
            share(kind == 2),
            share(kind == 3),
            share(kind == 4),
            share(kind == 5),
            share(kind == 0),
            share(kind == 6),
            np.minimum(length / per_word, 40) / 40,
            np.bincount(line, again, minlength=len(ends)) / per_word,
            different / per_word,
            np.bincount(line, ending == 5, minlength=len(ends)) / per_word,
            np.bincount(line, last - first == 1, minlength=len(ends)) / per_word,
            seen & (length > 0),
        ],
        axis=1,
    )
    return features.astype(np.float32), length, n_lines


def _first_of(line: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The line of each different (line, hash)."""
    order = np.lexsort((h, line))
    a, b = line[order], h[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new]


def with_neighbours(x: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the line before and after, zero at a text's ends, and a constant."""
    ends = np.cumsum(n_lines)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:] = x[:-1]
    after[:-1] = x[1:]
    before[np.concatenate([[0], ends[:-1]])] = 0
    after[ends - 1] = 0
    return np.concatenate([x, before, after, np.ones((len(x), 1), x.dtype)], axis=1)


@dataclass
class Chain:
    weights: np.ndarray  # of the label good against bad, per feature
    links: np.ndarray  # score of (label, next label)
    slope: float = 1.0
    shift: float = 0.0

    def marginals(self, score: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the expected number of each (label, next label), over all texts.

        Texts of similar length run side by side; each step handles one line of all of them.
        """
        out = np.empty(len(score))
        pairs = np.zeros((2, 2))
        starts = np.concatenate([[0], np.cumsum(n_lines)[:-1]])
        order = np.argsort(-n_lines, kind="stable")
        starts, counts = starts[order], n_lines[order]
        steps = int(counts[0])
        alive = np.searchsorted(-counts, -np.arange(steps), side="left")  # texts with more than t lines
        unary = np.zeros((len(score), 2))
        unary[:, 1] = score
        forward = np.empty((len(score), 2))
        forward[starts] = unary[starts]
        for t in range(1, steps):
            at = starts[: alive[t]] + t
            forward[at] = unary[at] + np.logaddexp(
                forward[at - 1, 0, None] + self.links[0], forward[at - 1, 1, None] + self.links[1]
            )
        back = np.zeros((len(score), 2))
        total = np.logaddexp(*forward[starts + counts - 1].T)
        for t in range(steps - 1, 0, -1):
            at = starts[: alive[t]] + t
            ahead = back[at] + unary[at]
            joint = forward[at - 1, :, None] + self.links + ahead[:, None, :] - total[: alive[t], None, None]
            pairs += np.exp(joint).sum(0)
            back[at - 1] = np.logaddexp(self.links[:, 0] + ahead[:, :1], self.links[:, 1] + ahead[:, 1:])
        owner = np.repeat(np.arange(len(counts)), counts)
        at = np.repeat(starts, counts) + np.arange(len(score)) - np.repeat(np.cumsum(counts) - counts, counts)
        out[at] = np.exp(forward[at, 1] + back[at, 1] - total[owner])
        return out, pairs

    def quality(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the length-weighted share of good lines; the lines' probabilities, and lines per text."""
        x, length, n_lines = line_features(texts)
        good, _ = self.marginals(with_neighbours(x, n_lines) @ self.weights, n_lines)
        return weighted(good, length, n_lines), good, n_lines

    def score(self, share: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * share + self.shift, -30, 30)))


def weighted(good: np.ndarray, length: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    at = np.concatenate([[0], np.cumsum(n_lines)[:-1]])
    weight = length + 1.0
    return np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at)


def fit(x: np.ndarray, length: np.ndarray, n_lines: np.ndarray, label: np.ndarray, steps: int = 80) -> Chain:
    """Maximum conditional likelihood by Adam steps, with a small pull towards zero; then the logistic curve."""
    x = with_neighbours(x, n_lines).astype(np.float64)
    y = np.repeat(label, n_lines)
    ends = np.cumsum(n_lines)
    inner = np.ones(len(x), bool)
    inner[ends - 1] = False
    nxt = np.flatnonzero(inner)
    seen = np.array([[np.sum((y[nxt] == a) & (y[nxt + 1] == b)) for b in (0, 1)] for a in (0, 1)], float)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        chain = Chain(theta[:-4], theta[-4:].reshape(2, 2))
        good, pairs = chain.marginals(x @ chain.weights, n_lines)
        gradient = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) / len(x) - 1e-4 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.2 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    chain = Chain(theta[:-4], theta[-4:].reshape(2, 2))
    share = weighted(chain.marginals(x @ chain.weights, n_lines)[0], length, n_lines)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on the share
        p = 1 / (1 + np.exp(-np.clip(slope * share + shift, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([np.sum((label - p) * share), np.sum(label - p)]) - 1e-2 * np.array([slope, 0])
        h = np.array([[np.sum(w * share * share) + 1e-2, np.sum(w * share)], [np.sum(w * share), np.sum(w) + 1e-6]])
        slope, shift = np.array([slope, shift]) + np.linalg.solve(h, g)
    chain.slope, chain.shift = float(slope), float(shift)
    return chain


def held_out(id_col: str):
    """True for a third of the ids, those whose crc32 as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = 2000,
    max_lines: int = 200,
) -> Chain:
    """Fit on at most `max_docs` labelled documents that are not held out, chosen by a hash of their id."""
    known = (
        labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & ~held_out(id_col))
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("id"))
        .agg((F.avg(f"`{label_col}`") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_docs)
    )
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    sample = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    sample = sample.join(F.broadcast(known), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t for t in utf8(batch.column(1))]
            rows = []
            for i, (text, label, key) in enumerate(zip(texts, batch.column(2).to_pylist(), batch.column(0).to_pylist(), strict=True)):
                if text.count(b"\n") < max_lines:
                    x, length, _ = line_features([texts[i]])
                    rows.append((key, label, x.tobytes(), length.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                names=["id", "label", "features", "length"],
            )

    rows = small_batches(sample).mapInArrow(tidy(run), "id bigint, label int, features binary, length binary").collect()
    rows.sort(key=lambda r: r.id)
    y = np.array([r.label for r in rows], float)
    if not rows or y.min() == y.max():
        share = float(y.mean()) if rows else 0.5
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Chain(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), 0.0, float(np.log(p / (1 - p))))
    x = [np.frombuffer(r.features, np.float32).reshape(-1, FEATURES) for r in rows]
    length = np.concatenate([np.frombuffer(r.length, "<i8") for r in rows])
    return fit(np.concatenate(x), length, np.array([len(a) for a in x]), y)


def score_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", line_col: str | None = None) -> DataFrame:
    """The columns of `docs` and (score, predicted), under these names or, if taken, with underscores after them;
    with `line_col` also the probability of each line."""
    score, predicted = fresh_name(docs, "score"), fresh_name(docs, "predicted")
    schema = ", ".join(f"`{n}` {t.replace('void', 'string')}" for n, t in docs.dtypes)
    schema += f", `{score}` double, `{predicted}` int" + (f", `{line_col}` array<double>" if line_col else "")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(at).cast(pa.string()))
            for lo, hi in by_bytes([len(t) for t in texts], BLOCK_BYTES):
                share, good, n_lines = chain.quality(texts[lo:hi])
                result = chain.score(share)
                columns = [*batch.slice(lo, hi - lo).columns, pa.array(result), pa.array((result >= 0.5).astype(np.int32))]
                names = [*batch.schema.names, score, predicted]
                if line_col:
                    columns.append(pa.array(np.split(good, np.cumsum(n_lines)[:-1]), pa.list_(pa.float64())))
                    names.append(line_col)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return small_batches(docs).mapInArrow(tidy(run), schema)
