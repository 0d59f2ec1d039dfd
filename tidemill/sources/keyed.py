"""Parquet tables that change by key: copy-on-write by bucket, with a log of the rows before and after.

Rows are dealt over buckets by a hash of their key, or by a whole number that the caller derives from it. A change writes the
buckets it touches as a new version beside the old ones, and last one state row that names the version of every bucket.
Readers take the newest complete state: a job that is lost between two buckets, or before the state, leaves the table as
it was, and its leftovers are never read. Untouched buckets keep their files.

One writer at a time. Null keys are keys like others. What reaches the driver is the list of buckets.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemill.operators.ranking import latest_per_key
from tidemill.session import materialize
from tidemill.sources.tables import partition_values

SIGN = "_sign"
BUCKET = "_bucket"
PART = "key_bucket"  # names the folder of a bucket
STATE = "buckets map<bigint,bigint>, columns string, through bigint"


@dataclass(frozen=True)
class State:
    """Version of each bucket, the columns, and how far a source has been applied."""

    version: int = 0
    buckets: dict[int, int] = field(default_factory=dict)
    columns: StructType | None = None
    through: int | None = None


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


class KeyedTable:
    """A table with one row per key; with `version` columns the newest version of a key stays."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        version: tuple[str, ...] = (),
        buckets: int = 64,
        bucket: Column | None = None,
    ):
        self.spark, self.path, self.keys, self.version = spark, path.rstrip("/"), keys, version
        given = F.pmod(F.xxhash64(*keys), F.lit(buckets)) if keys and bucket is None else bucket
        self.bucket = F.lit(-1).cast("long") if given is None else F.coalesce(given.cast("long"), F.lit(-1))

    # --- reading

    def _complete(self) -> list[int]:
        """Versions whose state is written, newest first."""
        found = []
        for v in sorted((int(v) for v in partition_values(self.spark, f"{self.path}/state", "version")), reverse=True):
            done, fs = _path(self.spark, f"{self.path}/state/version={v}/_SUCCESS")
            if fs.exists(done):
                found.append(v)
        return found

    def state(self, version: int | None = None) -> State:
        known = self._complete()
        if version is None and not known:
            return State()
        version = known[0] if version is None else version
        row = self.spark.read.schema(STATE).parquet(f"{self.path}/state/version={version}").first()
        columns = StructType.fromDDL(row["columns"]) if row["columns"] else None
        return State(version, dict(row["buckets"]), columns, row["through"])

    def read(self, only: list[int] | None = None) -> DataFrame | None:
        """The rows, of some buckets if named; None before the first change."""
        return self._rows(self.state(), only)

    def _rows(self, state: State, only: list[int] | None = None) -> DataFrame | None:
        if state.columns is None:
            return None
        chosen = [b for b in state.buckets if only is None or b in only]
        folders = [f"{self.path}/data/version={state.buckets[b]}/{PART}={b}" for b in chosen]
        if not folders:
            return self.spark.createDataFrame([], state.columns)
        return self.spark.read.schema(state.columns).parquet(*folders)

    def changes(self, after: int, upto: int | None = None) -> DataFrame | None:
        """Rows before (`_sign` -1) and after (+1) of the changes since a version; None if there are none.

        A reader that is older than what `vacuum` has kept gets an error, not a part of the changes.
        """
        upto = self.state().version if upto is None else upto
        wanted = [v for v in self._complete() if after < v <= upto]
        logged = {int(v) for v in partition_values(self.spark, f"{self.path}/changes", "version")}
        if after < self._vacuumed():
            raise ValueError(f"changes after version {after} are not kept any more")
        folders = [f"{self.path}/changes/version={v}" for v in wanted if v in logged]
        if not folders:
            return None
        columns = StructType(list(self.state(upto).columns.fields)).add(SIGN, IntegerType())
        return self.spark.read.schema(columns).parquet(*folders)

    def _vacuumed(self) -> int:
        gone = partition_values(self.spark, f"{self.path}/vacuumed", "version")
        return max((int(v) for v in gone), default=0)

    # --- writing

    def merge(self, updates: DataFrame, deletes: DataFrame | None = None, through: int | None = None) -> State:
        """Insert or replace the rows of `updates`, delete the keys of `deletes`; the state after it.

        Of repeated keys in `updates` the newest version is used, without version columns the greatest row. A row that
        is stored in a newer version stays; in the same version it is replaced. New columns are appended. Changes that
        change nothing write nothing. `through` is kept with the state: one that is not beyond the last is skipped.
        """
        state = self.state()
        if through is not None and state.through is not None and through <= state.through:
            return state
        fresh = latest_per_key(updates, self.keys, *self.version).select("*", F.lit(False).alias("_gone"))
        if deletes is not None:
            gone = deletes.select(*self.keys).distinct().withColumn("_gone", F.lit(True))
            fresh = fresh.join(gone.drop("_gone"), self.keys, "left_anti").unionByName(gone, allowMissingColumns=True)
        batch = materialize(fresh.withColumn(BUCKET, self.bucket), "batch")
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]
        old = self._rows(state, touched)
        columns = self._all_columns(state, updates)
        names = [f.name for f in columns]

        key = F.struct(*self.keys)
        new_side = batch.select(key.alias("_k"), "_gone", F.struct(*[F.col(c) if c in batch.columns else F.lit(None).alias(c) for c in names]).alias("_new"))
        if old is None:
            hit = new_side.withColumn("_old", F.lit(None).cast(columns))
        else:
            old = old.select(*[F.col(c) if c in old.columns else F.lit(None).cast(columns[c].dataType).alias(c) for c in names])
            hit = new_side.join(old.select(key.alias("_k"), F.struct(*names).alias("_old")), "_k", "left")
        here = F.col("_old").isNotNull()
        newer = F.lit(True)
        if self.version:
            newer = F.struct(*[F.col(f"_new.{c}") for c in self.version]) >= F.struct(*[F.col(f"_old.{c}") for c in self.version])
        takes = F.when(F.col("_gone"), here).otherwise(~here | (newer & ~F.col("_new").eqNullSafe(F.col("_old"))))
        before = F.when(here, F.struct(F.lit(-1).alias(SIGN), F.col("_old").alias("r")))
        after = F.when(~F.col("_gone"), F.struct(F.lit(1).alias(SIGN), F.col("_new").cast(columns).alias("r")))
        signed = hit.where(takes).select(F.explode(F.filter(F.array(before, after), lambda x: x.isNotNull())).alias("c"))
        signed = signed.select("c.r.*", F.col(f"c.{SIGN}").alias(SIGN))

        version = self._next()
        signed.write.parquet(f"{self.path}/changes/version={version}")
        log = self.spark.read.schema(StructType(list(columns.fields)).add(SIGN, IntegerType())).parquet(f"{self.path}/changes/version={version}")
        rewritten = [r[0] for r in log.select(self.bucket.alias(BUCKET)).distinct().collect()]
        rows = log.where(F.col(SIGN) > 0).drop(SIGN)
        if old is not None and rewritten:
            kept = self._rows(state, rewritten).select(key.alias("_k"), "*").join(log.select(key.alias("_k")).distinct(), "_k", "left_anti")
            rows = kept.drop("_k").unionByName(rows, allowMissingColumns=True)
        return self._commit(version, state, rows, rewritten, columns, through)

    def rewrite(self, rows: DataFrame, touched: list[int], through: int | None = None) -> State:
        """Replace whole buckets; `rows` are all rows of the touched ones. Such changes are not logged."""
        state = self.state()
        version = self._next()
        self._mark("vacuumed", version)  # readers of the log have to start again
        return self._commit(version, state, rows, touched, self._all_columns(state, rows), through)

    def _all_columns(self, state: State, rows: DataFrame) -> StructType:
        known = list(state.columns.fields) if state.columns else []
        names = {f.name for f in known}
        return StructType(known + [StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in names])

    def _next(self) -> int:
        """A number that no version has used, a lost one's included."""
        folders = ("state", "data", "changes", "vacuumed")
        return 1 + max((int(v) for f in folders for v in partition_values(self.spark, f"{self.path}/{f}", "version")), default=0)

    def _commit(self, version: int, state: State, rows: DataFrame, touched: list[int], columns: StructType, through: int | None) -> State:
        data = f"{self.path}/data/version={version}"
        buckets = dict(state.buckets)
        if touched:
            dealt = rows.withColumn(PART, self.bucket).hint("rebalance", PART)
            dealt.write.partitionBy(PART).parquet(data)
            written = {int(b) for b in partition_values(self.spark, data, PART)}
            buckets = {b: v for b, v in buckets.items() if b not in touched} | dict.fromkeys(written, version)
        through = state.through if through is None else through
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        one = self.spark.createDataFrame([(buckets, ddl, through)], STATE)
        one.coalesce(1).write.parquet(f"{self.path}/state/version={version}")
        return State(version, buckets, columns, through)

    def _mark(self, what: str, version: int) -> None:
        self.spark.range(0).write.mode("overwrite").parquet(f"{self.path}/{what}/version={version}")

    def vacuum(self, keep: int = 2) -> None:
        """Delete what none of the newest `keep` states names, and the changes before them."""
        known = self._complete()
        if len(known) <= keep:
            return
        oldest = known[keep - 1]
        named = {(v, b) for k in known[:keep] for b, v in self.state(k).buckets.items()}
        self._mark("vacuumed", oldest)
        for v in (int(v) for v in partition_values(self.spark, f"{self.path}/data", "version")):
            for b in (int(b) for b in partition_values(self.spark, f"{self.path}/data/version={v}", PART)):
                if v <= known[0] and (v, b) not in named:
                    delete(self.spark, f"{self.path}/data/version={v}/{PART}={b}")
        for what in ("state", "changes"):
            for v in (int(v) for v in partition_values(self.spark, f"{self.path}/{what}", "version")):
                if v < oldest or (what == "changes" and v == oldest):
                    delete(self.spark, f"{self.path}/{what}/version={v}")


# --- views of sums that follow a keyed table ----------------------------------------------


def _signed(x: Column) -> Column:
    return F.when(F.col(SIGN) < 0, -x).otherwise(x)


def _totals(rows: DataFrame, group: str, sums: dict[str, str]) -> DataFrame:
    """Per group the signed sums, how many values each has, and the number of rows."""
    parts = [F.sum(F.col(SIGN)).alias("row_count")]
    for name, column in sums.items():
        parts += [F.sum(_signed(F.col(column))).alias(name), F.sum(F.when(F.col(column).isNotNull(), F.col(SIGN)).otherwise(0)).alias(f"{name}_values")]
    return rows.groupBy(group).agg(*parts)


def summed_view(spark: SparkSession, path: str, group: str, bucket: Column | None = None) -> KeyedTable:
    return KeyedTable(spark, path, [group], bucket=bucket)


def follow(source: KeyedTable, view: KeyedTable, sums: dict[str, str]) -> State:
    """Bring the view up to the source: only groups whose totals change are read and written.

    A changed row's old contribution is subtracted and its new one added, from the source's change log; groups without
    rows go. The first time, or if the log reaches back too far, the view is made from the whole source. The source's version is kept with the view, so a
    run that is repeated, or lost before its end, counts nothing twice.
    """
    (group,) = view.keys
    now, seen = source.state(), view.state()
    if now.version == 0 or seen.through == now.version:
        return seen
    if seen.columns is None or seen.through is None or seen.through < source._vacuumed():
        whole = _totals(source.read().withColumn(SIGN, F.lit(1)), group, sums)
        stale = None if seen.columns is None else view.read().select(group).join(whole.select(group), group, "left_anti")
        return view.merge(whole, deletes=stale, through=now.version)
    log = source.changes(seen.through, now.version)
    if log is None:
        return view.merge(view.read([]), through=now.version)
    delta = _totals(log, group, sums)
    moved = [F.col("row_count") != 0] + [F.coalesce(F.col(c) != 0, F.lit(False)) | (F.col(f"{c}_values") != 0) for c in sums]
    delta = materialize(delta.where(reduce(lambda a, b: a | b, moved)), "delta")
    touched = [r[0] for r in delta.select(view.bucket).distinct().collect()]
    old = view.read(touched)
    both = delta.select(F.struct(group).alias("_k"), F.struct("*").alias("d")).join(
        old.select(F.struct(group).alias("_k"), F.struct("*").alias("o")), "_k", "left"
    )

    def added(name: str) -> Column:
        kind = seen.columns[name].dataType
        d, o = F.col(f"d.{name}"), F.col(f"o.{name}")
        return (F.coalesce(d, F.lit(0).cast(kind)) + F.coalesce(o, F.lit(0).cast(kind))).cast(kind)

    counts = {c: added(c) for c in ["row_count", *(f"{c}_values" for c in sums)]}
    values = {c: F.when(counts[f"{c}_values"] != 0, added(c)) for c in sums}
    rows = both.select(F.col(f"_k.{group}").alias(group), *[c.alias(n) for n, c in (counts | values).items()])
    rows = materialize(rows, "totals")
    return view.merge(rows.where("row_count != 0"), deletes=rows.where("row_count = 0"), through=now.version)
