"""Token counts of whole texts: only lengths leave the Arrow functions.

Texts are handed to the library in batches of about equal bytes; a long text is first split at
places where no token can cross: where a space stands between two letters and, for files whose words are runs
of letters, of numbers or of neither, wherever the class changes, so texts of any script are cut at marks and spaces.
A single run of one class, such as a million letters without a mark, is one word to those files and goes whole. Null and empty texts count 0 tokens; repeated rows give a row each; only the id and the text
are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemill.llm.common import by_bytes, columns, read_bounded, small_batches, strings
from tidemill.llm.tokenizer_files import loaded, safe_pieces


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    pattern: str | None = None,
    batch_bytes: int = 1 << 18,
    piece_chars: int = 1 << 15,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row; over_limit says n_tokens > limit."""
    blob, suffix = read_bounded(tokenizer_path), os.path.splitext(tokenizer_path)[1]
    source = columns(docs, id_col, text_col)
    source = source.select(source[0], source[1].cast("string"))
    schema = f"`{id_col}` {source.dtypes[0][1].replace('void', 'bigint')}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(blob, suffix, pattern)
        for batch in batches:
            pieces, owner, sizes, n_bytes = [], [], [], [0] * batch.num_rows
            for k, text in enumerate(strings(batch.column(1))):
                for piece in safe_pieces(text, piece_chars, encoder.cuts, encoder.whole) if encoder.can_cut else [text]:
                    pieces.append(piece)
                    owner.append(k)
                    sizes.append(len(piece) if piece.isascii() else len(piece.encode()))
                    n_bytes[k] += sizes[-1]
            counts = [0] * batch.num_rows
            for lo, hi in by_bytes(sizes, batch_bytes):
                for k, n in zip(owner[lo:hi], encoder.count(pieces[lo:hi]), strict=True):
                    counts[k] += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return small_batches(source).mapInArrow(run, schema)
