"""Exact de-duplication against an immutable snapshot screened by static binary fuse filters.

The table is taken as a snapshot and a batch that comes in. The snapshot's digests are grouped, dealt
over buckets by their first bytes, and each bucket gets a filter that is built once and never changed.
The batch's own copies are grouped separately; its distinct digests are screened by the filter of their
bucket, only the positives are joined with the exact bucket, and the negatives are new groups without a
look at the snapshot. Texts of groups of two and more are then compared byte by byte with the text that
stays; a digest shared by different texts stops the job rather than merging them.

Only digests are shuffled, and of texts only those with a copy: a filter of the repeated digests, used
while it is below FILTER_BYTES and skipped beyond, keeps all other texts where they are. Groups are
summed up before they meet their rows again, so a text that a third of the rows repeat is one row there.

Null texts count as empty; empty texts are equal. The row with the largest id stays, a null id being the
smallest; of rows with equal id and text the first one read stays, and is one row. An empty table
gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import fuse
from tidemill.llm.common import columns, fresh_name, numbered, small_batches, tidy, utf8
from tidemill.session import discard, materialize, shuffles_freed

KEYS_PER_BUCKET = 200_000
FILTER_BYTES = 16 << 20
LOWEST = -(1 << 63)


def normalized(text: bytes) -> bytes:
    """Lower-case A-Z only: bytes.lower() leaves every other byte of UTF-8 as it is."""
    return text.lower()


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def _keys(digests: list[bytes]) -> np.ndarray:
    """The 64-bit keys that filters hold; the digest's first bytes choose the bucket, so these come later."""
    return np.array([int.from_bytes(d[-8:], "little") for d in digests], np.uint64)


def digest_rows(
    docs: DataFrame, id_col: str, text_col: str, digest: Callable[[bytes], bytes], row_col: str | None = None
) -> DataFrame:
    """(row, id, digest) per row of `docs`."""
    source = docs.select(
        (F.monotonically_increasing_id() if row_col is None else F.col(f"`{row_col}`")).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest(normalized(x)) for x in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["row", "id", "digest"]
            )

    return small_batches(source).mapInArrow(tidy(run), "row bigint, id bigint, digest binary")


def bucket_of(digest: Column, buckets: int) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long") % buckets


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, size, last): copies in number, and (id, -row) of the one that stays."""
    return rows.groupBy("digest").agg(
        F.count("*").alias("size"),
        F.max(F.struct(F.coalesce("id", F.lit(LOWEST)).alias("id"), (-F.col("row")).alias("back"))).alias("last"),
    )


def filters_of(digests: DataFrame) -> DataFrame:
    """(bucket, filter) of the distinct digests per bucket."""

    def make(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [key[0]], "filter": [fuse.build(_keys(group["digest"].tolist()))]})

    return digests.select("bucket", "digest").groupBy("bucket").applyInPandas(make, "bucket bigint, filter binary")


def buckets_for(n: int) -> int:
    return max(8, -(-n // KEYS_PER_BUCKET))


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """`batch` (bucket, digest, size, last) with `maybe`: whether the filter of its bucket knows the digest."""

    def test(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(rows), bool)
        for blob in known["filter"]:
            hit |= fuse.contains(blob, _keys(rows["digest"].tolist()))
        return pd.DataFrame({"digest": rows["digest"], "maybe": hit})

    tested = (
        batch.select("bucket", "digest")
        .groupBy("bucket")
        .cogroup(filters.groupBy("bucket"))
        .applyInPandas(test, "digest binary, maybe boolean")
    )
    return batch.join(tested, "digest")


def texts_of(docs: DataFrame, repeated: DataFrame, text_col: str, id_col: str, digest) -> DataFrame:
    """(digest, id, text) of the rows whose digest may be among the repeated ones."""
    total = repeated.count()
    buckets = buckets_for(total)
    blobs = None
    if total * 1.3 < FILTER_BYTES:
        found = filters_of(repeated.withColumn("bucket", bucket_of(F.col("digest"), buckets))).collect()
        blobs = {r.bucket: bytes(r.filter) for r in found}
    source = columns(docs, id_col, text_col)
    source = source.select(source[0].cast("long").alias("id"), source[1].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalized(x) for x in utf8(batch.column(1))]
            digests = [digest(x) for x in texts]
            keep = np.ones(len(texts), bool)
            if blobs is not None and texts:
                where = np.array([int.from_bytes(d[:4], "big") % buckets for d in digests])
                keys = _keys(digests)
                keep[:] = False
                for b in np.unique(where).tolist():
                    at = np.flatnonzero(where == b)
                    if b in blobs:
                        keep[at] = fuse.contains(blobs[b], keys[at])
            at = np.flatnonzero(keep).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digests[i] for i in at], pa.binary()),
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array([texts[i] for i in at], pa.binary()),
                ],
                names=["digest", "id", "text"],
            )

    return small_batches(source).mapInArrow(tidy(run), "digest binary, id bigint, text binary")


def exact_groups(
    docs: DataFrame,
    incoming: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[bytes], bytes] = sha256,
    row_col: str | None = None,
) -> DataFrame:
    """(row, id, keep_id, group_size, kept, digest) per row of `docs`.

    `incoming` tells the batch from the snapshot by the column `id`; by default odd ids come in. `row` is the
    number that `row_col` names in a written table; without it, one drawn here that cannot be joined with `docs`.
    """
    return _groups(docs, incoming, id_col, text_col, digest, row_col)[0]


def _groups(
    docs: DataFrame, incoming: Column | None, id_col: str, text_col: str, digest: Callable[[bytes], bytes], row_col: str | None
) -> tuple[DataFrame, list[DataFrame]]:
    """`exact_groups` and the tables written for it, which it reads."""
    tables: list[DataFrame] = []

    def written(df: DataFrame, label: str) -> DataFrame:
        tables.append(materialize(df, label))
        return tables[-1]

    incoming = F.coalesce(F.pmod("id", F.lit(2)), F.lit(0)) == 1 if incoming is None else incoming
    rows = digest_rows(docs, id_col, text_col, digest, row_col)
    rows = written(rows.withColumn("incoming", F.coalesce(incoming, F.lit(False))), "digests")

    old = written(grouped(rows.where(~F.col("incoming"))), "snapshot")
    buckets = buckets_for(old.count())
    old = old.withColumn("bucket", bucket_of(F.col("digest"), buckets))
    filters = written(filters_of(old), "filters")
    new = grouped(rows.where("incoming")).withColumn("bucket", bucket_of(F.col("digest"), buckets))
    new = written(screen(new, filters), "screened")

    before = old.select("digest", F.col("size").alias("old_size"), F.col("last").alias("old_last"))
    met = new.where("maybe").join(before, "digest", "left")
    met = met.select(
        "digest",
        (F.col("size") + F.coalesce("old_size", F.lit(0))).alias("size"),
        F.greatest("last", "old_last").alias("last"),
        F.col("old_size").isNotNull().alias("known"),
    )
    met = written(met, "met")
    groups = (
        met.drop("known")
        .unionByName(new.where(~F.col("maybe")).select("digest", "size", "last"))
        .unionByName(old.select("digest", "size", "last").join(met.where("known").select("digest"), "digest", "left_anti"))
    )
    groups = written(groups, "groups")

    repeated = groups.where("size > 1")
    texts = texts_of(docs, repeated.select("digest"), text_col, id_col, digest)
    compared = texts.join(repeated.select("digest", F.col("last.id").alias("keep")), "digest")
    compared = written(compared, "texts")
    stays = compared.where(F.coalesce("id", F.lit(LOWEST)) == F.col("keep")).groupBy("digest").agg(F.min("text").alias("stays"))
    checked = (
        compared.select("digest", "text")
        .join(stays, "digest")
        .groupBy("digest")
        .agg(F.sum((F.col("text") == F.col("stays")).cast("long")).alias("equal"))
    )
    trouble = F.raise_error(F.lit("different texts share a digest")).cast("long")
    sizes = repeated.join(checked, "digest", "left").select(
        "digest", F.when(F.col("equal") == F.col("size"), F.col("equal")).otherwise(trouble).alias("size"), "last"
    )
    groups = groups.where("size = 1").unionByName(sizes)
    found = rows.join(groups, "digest").select(
        "row",
        "id",
        F.when(F.col("last.id") != LOWEST, F.col("last.id")).alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == -F.col("last.back")).alias("kept"),
        "digest",
    )
    return found, tables


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    row = fresh_name(docs, "row")
    with shuffles_freed(docs.sparkSession):
        docs = numbered(docs, row)
        groups, tables = _groups(docs, None, id_col, text_col, sha256, row)
        gone = materialize(groups.where(~F.col("kept")).select(F.col("row").alias(row)), "gone")  # written, so that the join knows its size
        discard(*tables)
    return docs.join(gone, row, "left_anti").drop(row)
