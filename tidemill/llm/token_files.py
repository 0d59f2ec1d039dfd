"""Token-id files: flat unsigned integers plus 64-bit document offsets.

A folder holds, per partition of the ascending document order, `ids-NNNNN.bin` (unsigned 16- or 32-bit
little-endian ids, documents one after the other), `offsets-NNNNN.bin` (n + 1 unsigned 64-bit numbers:
where each document starts in the whole corpus, then the end of the last) and `docs-NNNNN.bin` (n
signed 64-bit document ids). A partition's first offset is the prefix sum of the partitions before it:
tasks write ids and return only their counts; the bases of a few thousand counts are summed on the
driver, and a second small job writes the offsets. `manifest.json` lists the partitions.

Files are written under a name of the task attempt and then moved, so a task that is run again
replaces its own file. Readers map local files into memory and open other stores as streams.

Null and empty texts hold the end id alone; rows with equal ids keep a place each, ordered by their
size; a null id is stored as the smallest 64-bit number and read back as null. An empty table writes a
manifest without partitions. Only the id and the text are read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import by_bytes, columns, read_bounded, small_batches, store, strings
from tidemill.llm.tokenizer_files import loaded, memory, safe_pieces, vocabulary_size

NULL_ID = -(1 << 63)
ENCODED = "id bigint, n_tokens bigint, ids binary, part int, mark bigint"
WRITTEN = "part int, path string, n_docs bigint, n_tokens bigint"


def _write(fs: pafs.FileSystem, path: str, parts: Iterator[bytes]) -> None:
    draft = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    fs.move(draft, path)


def _numbers(fs: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with fs.open_input_stream(path) as f:
        return np.frombuffer(f.read(), kind)


def encode_ids(
    docs: DataFrame, tokenizer_path: str, end_id: int | None, kind: str, bounds: list[int], id_col: str, text_col: str
) -> DataFrame:
    """(id, n_tokens, ids, part, mark) per row; `part` counts the bounds below the id.

    An id that is several bounds at once holds as many parts' rows; they are dealt over these by a hash of the text.
    """
    blob, suffix = read_bounded(tokenizer_path), os.path.splitext(tokenizer_path)[1]
    source = columns(docs, id_col, text_col)
    text = source[1].cast("string")
    source = source.select(source[0].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    edges = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(blob, suffix)
        if encoder.words_apart:
            piece, pack = 1 << 19, memory(encoder, kind).packed
        else:
            piece, pack = 1 << 15, lambda some: [np.array(ids, kind).tobytes() for ids in encoder.encode(some)]
        for batch in batches:
            texts = strings(batch.column(1))
            pieces, owner = [], []
            for k, text in enumerate(texts):
                found = safe_pieces(text, piece, encoder.cuts, encoder.whole) if encoder.can_cut else [text]
                pieces += found
                owner += [k] * len(found)
            packed: list[list[bytes]] = [[] for _ in texts]
            for lo, hi in by_bytes([len(p) for p in pieces], 8 * piece):
                for k, ids in zip(owner[lo:hi], pack(pieces[lo:hi]), strict=True):
                    packed[k].append(ids)
            end = b"" if end_id is None else np.array([end_id], kind).tobytes()
            rows = [b"".join(parts) + end for parts in packed]
            width = np.dtype(kind).itemsize
            keys, marks = batch.column(0).fill_null(NULL_ID).to_numpy(), batch.column(2).to_numpy()
            first, last = np.searchsorted(edges, keys), np.searchsorted(edges, keys, "right")
            share = (marks / 2.0**64 + 0.5).clip(0, 1 - 2.0**-32)  # in the order of the marks
            part = first + (np.maximum(last - first, 1) * share).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(x) // width for x in rows], pa.int64()),
                    pa.array(rows, pa.binary()),
                    pa.array(part, pa.int32()),
                    batch.column(2),
                ],
                names=["id", "n_tokens", "ids", "part", "mark"],
            )

    return small_batches(source).mapInArrow(run, ENCODED)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = None,
    kind: str | None = None,
    partitions: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> str:
    """Encode `docs` and write them in ascending id order; returns the folder.

    Rows of one id are in the order of a hash of their texts. Without a `kind`, ids take two bytes if all of the
    vocabulary's do, else four.
    """
    if kind is None:
        largest = max(vocabulary_size(read_bounded(tokenizer_path), os.path.splitext(tokenizer_path)[1]), (end_id or 0) + 1)
        kind = "<u2" if largest <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    fs, base = store(folder)
    fs.create_dir(base, recursive=True)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Bounds come from the ids alone: a range partitioning would encode every text twice, once to sample it.
    steps = [k / parts for k in range(1, parts)] or [0.5]
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID))
    bounds = docs.agg(F.percentile_approx(key, steps, 100 * parts)).first()[0] or []
    encoded = encode_ids(docs, tokenizer_path, end_id, kind, sorted(bounds), id_col, text_col)
    ordered = encoded.repartitionById(parts, "part").sortWithinPartitions("part", "id", "mark", "n_tokens", "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, out_base = store(folder)
        shape = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        part, draft, sink, counts, ids = -1, "", None, [], []

        def close() -> pa.RecordBatch:
            sink.close()
            out_fs.move(draft, f"{out_base}/ids-{part:05d}.bin")
            _write(out_fs, f"{out_base}/docs-{part:05d}.bin", iter([np.array(ids, "<i8").tobytes()]))
            _write(out_fs, f"{out_base}/lengths-{part:05d}.bin", iter([np.array(counts, "<u8").tobytes()]))
            row = {"part": part, "path": f"ids-{part:05d}.bin", "n_docs": len(counts), "n_tokens": sum(counts)}
            return pa.RecordBatch.from_pylist([row], schema=shape)

        for batch in batches:  # sorted by part: a task may hold several, one after the other
            parts_of = batch.column(3).to_pylist()
            for row, (x, n, key) in enumerate(
                zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), batch.column(0).fill_null(NULL_ID).to_pylist(), strict=True)
            ):
                if parts_of[row] != part:
                    if sink is not None:
                        yield close()
                    part, counts, ids = parts_of[row], [], []
                    draft = f"{out_base}/ids-{part:05d}.bin.{uuid.uuid4().hex}"
                    sink = out_fs.open_output_stream(draft)
                sink.write(x)
                counts.append(n)
                ids.append(key)
        if sink is not None:
            yield close()

    written = sorted(small_batches(ordered).mapInArrow(write, WRITTEN).collect())  # a row per partition
    bases = np.concatenate([[0], np.cumsum([r.n_tokens for r in written], dtype=np.int64)]).tolist()
    shards = [
        {"part": r.part, "base": b, "n_docs": r.n_docs, "n_tokens": r.n_tokens}
        for r, b in zip(written, bases, strict=False)
    ]

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, out_base = store(folder)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                shard = shards[k]
                lengths = _numbers(out_fs, f"{out_base}/lengths-{shard['part']:05d}.bin", "<u8")
                starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8") + np.uint64(shard["base"])
                _write(out_fs, f"{out_base}/offsets-{shard['part']:05d}.bin", iter([starts.tobytes()]))
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["id"])

    if shards:
        spark.range(0, len(shards), 1, len(shards)).mapInArrow(offsets, "id bigint").count()
    manifest = {"kind": kind, "end_id": end_id, "n_tokens": bases[-1], "shards": shards}
    _write(fs, f"{base}/manifest.json", iter([json.dumps(manifest).encode()]))
    return folder


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True, docs_per_batch: int = 256) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, and the ids as stored; a task maps one partition's files."""
    fs, base = store(folder)
    with fs.open_input_stream(f"{base}/manifest.json") as f:
        manifest = json.loads(f.read())
    kind, shards = manifest["kind"], manifest["shards"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_fs, in_base = store(folder)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                shard = shards[k]
                ids, docs, starts = (
                    _numbers(in_fs, f"{in_base}/{name}-{shard['part']:05d}.bin", t)
                    for name, t in (("ids", kind), ("docs", "<i8"), ("offsets", "<u8"))
                )
                for lo in range(0, len(docs), docs_per_batch):
                    some = docs[lo : lo + docs_per_batch]
                    at = starts[lo : lo + len(some) + 1].astype(np.int64)
                    rows = [
                        ids[a:b] for a, b in zip(at - shard["base"], at[1:] - shard["base"], strict=False)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some, pa.int64(), mask=np.asarray(some) == NULL_ID),
                            pa.array(at[:-1], pa.int64()),
                            pa.array(np.diff(at), pa.int64()),
                            pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in rows], pa.int64()),
                            *([pa.array([x.tobytes() for x in rows], pa.binary())] if with_ids else []),
                        ],
                        names=["id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids],
                    )

    tasks = max(1, len(shards))
    return spark.range(0, len(shards), 1, tasks).mapInArrow(
        run, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    )
