"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target of words: its share of the budget by weight, at most `most` times its size, the
excess being shared again among the others. Whole epochs come first; for what remains, documents get
the key -ln(u) / quality with u drawn by a hash of the seed and the document, and are taken in ascending
order of the key until their words reach the remaining target. So documents of higher quality come sooner,
and reruns agree.

No source is sorted in one task. Rows are range-partitioned by source and key, so that every partition, a bin, holds
about the same number of rows however keys and sources are distributed; prefix sums run over the bins of each source,
and only the bin in which the budget ends is ranked row by row. What the ranking gives is one limit per source, the last
key that is taken, and every row is held against it where it lies: texts are not shuffled.

Sources are ordered by code point, null last: one row per source, with two numbers, is the only thing ordered as a
whole. A null text has size 0 and no words to take. A null quality counts as 1. Rows with the same id and text
draw the same key and are ordered by the row they were read as. An empty table gives an empty result.
Only the id, the source and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidemill.llm.common import fresh_name, small_batches, tidy, utf8
from tidemill.session import materialize

ROWS_PER_BIN = 250_000


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality_col: str | None, whole: bool) -> tuple[DataFrame, dict[str, str]]:
    """A written table with row number, words, quality and a hash of the text per document, and the names of these columns.

    With `whole` it holds all of `docs`, else what the mix needs, without the text. Unless a column gives it, a
    document's quality is its share of different words.
    """
    names = {"id": id_col, "source": source_col}
    for added in ("row", "size", "quality", "mark"):
        names[added] = fresh_name(docs, added)
    text = F.col(f"`{text_col}`").cast("string")
    given = F.lit(None) if quality_col is None else F.col(f"`{quality_col}`")
    held = docs.columns if whole else dict.fromkeys((id_col, source_col))
    extra = {names["row"]: F.monotonically_increasing_id(), names["mark"]: F.xxhash64(text), names["quality"]: given.cast("double")}
    extra[fresh_name(docs, "measured")] = text
    rows = docs.select(*[F.col(f"`{c}`") for c in held], *[value.alias(name) for name, value in extra.items()])
    kept = rows.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, quality = [], []
            for words in map(bytes.split, utf8(batch.column(batch.num_columns - 1))):  # at ASCII white space only
                sizes.append(len(words))
                quality.append(len(set(words)) / len(words) if quality_col is None and words else 1.0)
            columns = list(batch.columns[:-1])
            if quality_col is None:
                columns[-1] = pa.array(quality, pa.float64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], names=[*(f.name for f in kept), names["size"]])

    schema = StructType(list(kept)).add(names["size"], LongType())
    return materialize(small_batches(rows).mapInArrow(tidy(run), schema), "measured"), names


def narrow(table: DataFrame, names: dict[str, str], *more: Column) -> DataFrame:
    """(row, id, source, size, quality, mark) of a measured table, and more columns of it."""
    kinds = {"id": "long", "source": "string", "row": "long", "size": "long", "quality": "double", "mark": "long"}
    return table.select(*[F.col(f"`{names[c]}`").cast(kind).alias(c) for c, kind in kinds.items()], *more)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    With level t a source gets min(most * size, weight * t). Sources reach their caps in the order of cap / weight;
    the level is found at the first source whose cap is above it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.withColumn("total", F.sum("source_size").over(everything) * float(share))
    ranked = ranked.withColumn("full", F.coalesce(F.sum("cap").over(filling), F.lit(0.0)))
    ranked = ranked.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    ranked = ranked.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # The level that holds for all: that of the first source that it does not fill, or none if all are full.
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)
    ranked = ranked.withColumn("level", fits["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap")))
    return ranked.select("source", "source_size", target.alias("target"))


def sampling_key(seed: int) -> Column:
    """-ln(u) / quality, with u in (0, 1) from a hash of seed, id, source and text."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "source", "mark"), 12)
    u = (bits.cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.greatest(F.coalesce("quality", F.lit(1.0)), F.lit(1e-3))


def same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def limits(rows: DataFrame, weights: Sequence[float], share: float, most: float, seed: int) -> DataFrame:
    """(source, source_size, target, epochs, last) as a written table: each source's target, whole epochs and the last
    (key, id, row) that is taken once more, null if none is."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = materialize(targets, "targets")

    bins = max(8, -(-rows.count() // ROWS_PER_BIN))
    keyed = rows.select("source", "size", F.struct(sampling_key(seed).alias("key"), "id", "row").alias("at"))
    keyed = keyed.repartitionByRange(bins, "source", "at").withColumn("bin", F.spark_partition_id())
    keyed = materialize(keyed, "drawn")
    sums = keyed.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    # The bin in which the remaining target is reached; bins below it are taken, bins above are not.
    ends = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest"))
    edge = sums.alias("b").join(targets.alias("t"), same_source("b", "t")).where(ends).select("b.source", F.col("bin").alias("edge"), "before", "rest")
    edge = materialize(edge, "edge")
    near = keyed.alias("k").join(edge.alias("e"), same_source("k", "e")).where(F.col("bin") <= F.col("edge"))
    near = near.select("k.source", "size", "at", "bin", "edge", "before", "rest")
    # The document that crosses the target is taken if that comes nearer to it than leaving it out; none after it is.
    up = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = near.where(F.col("bin") == F.col("edge"))
    reached = F.col("before") + F.coalesce(F.sum("size").over(up), F.lit(0))
    inside = inside.withColumn("reached", reached).where(F.col("reached") + F.col("size") / 2 <= F.col("rest"))
    below = near.where(F.col("bin") < F.col("edge"))
    last = inside.select("source", "at").unionByName(below.select("source", "at")).groupBy("source").agg(F.max("at").alias("last"))
    plan = targets.alias("t").join(last.alias("l"), same_source("t", "l"), "left")
    return materialize(plan.select("t.source", "source_size", "target", "epochs", "last"), "plan")


def times(seed: int) -> Column:
    """How often a row joined with its source's limits is taken."""
    at = F.struct(sampling_key(seed).alias("key"), "id", "row")
    return F.col("epochs") + F.coalesce(at <= F.col("last"), F.lit(False)).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality_col: str | None = None,
) -> DataFrame:
    """(row, id, size, source_size, target, times) per row; `times` says how often the mix takes the document.

    `row` tells rows of one result apart; it cannot be joined with `docs`.
    """
    rows = narrow(*measured(docs, id_col, text_col, source_col, quality_col, whole=False))
    plan = limits(rows, weights, share, most, seed)
    found = rows.alias("d").join(plan.alias("p"), same_source("d", "p")).select("d.*", "source_size", "target", "epochs", "last")
    return found.select("row", "id", "size", "source_size", "target", times(seed).alias("times"))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality_col: str | None = None,
) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    table, names = measured(docs, id_col, text_col, source_col, quality_col, whole=True)
    plan = limits(narrow(table, names), weights, share, most, seed)
    rows = narrow(table, names, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    found = rows.alias("d").join(plan.alias("p"), same_source("d", "p")).select("d.*", "epochs", "last")
    copies = F.explode(F.sequence(F.lit(1), times(seed).cast("int")))
    return found.where(times(seed) > 0).select("document", copies.alias("copy")).select("document.*")
