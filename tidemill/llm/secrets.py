"""Secret scan with corpus-wide ownership frequency.

Each text is scanned for candidates of the base kinds and for other long mixed strings. A candidate is
known only by a hash of its value. Hashes are counted over distinct repositories and owners of the
whole corpus: a value that many owners or many repositories hold is a widely copied example; any other that
looks random is a live-looking credential, also where a few owners or copies of one document hold it. Base spans
always stay and get that verdict; a mixed string becomes a span only if it is live-looking.

Counting reduces in steps, (value, owner, repository), (value, owner), value, each combined before its
shuffle, so a value that a third of the rows hold is a few rows per task.

Null and empty texts have no spans. A null owner or repository counts as one of its own; a repository is
told apart by its owner too. Repeated rows give a row each and count as one repository if they name
the same. An empty table gives an empty result. Only the id, text, owner and repository are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import small_batches, strings
from tidemill.session import materialize

KINDS = ["assign", "access", "hex", "mixed"]  # the order of spans that start together
# fixed values: the base patterns
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of fewer is no candidate, and runs are taken whole
MIXED = re.compile(r"[A-Za-z0-9+/_-]{20,}")
RANDOM_BITS = 3.0  # entropy per character of a value that looks random


def entropy(value: str) -> float:
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds, ordered by start, then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def mixed_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Long strings of upper and lower case letters and digits outside the base spans."""
    out = []
    for m in MIXED.finditer(text):
        value = m[0]
        if (
            any(c.isdigit() for c in value)
            and value.lower() != value != value.upper()
            and not any(start < m.end() and m.start() < end for start, _, end, _ in base)
        ):
            out.append((m.start(), 3, m.end(), value))
    return out


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


SCANNED = pa.schema(
    [
        ("row", pa.int64()),
        ("id", pa.int64()),
        ("owner", pa.string()),
        ("repository", pa.string()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.binary()), ("random", pa.bool_())]
                )
            ),
        ),
    ]
)
SCANNED_SQL = (
    "row bigint, id bigint, owner string, repository string, n_assign bigint, n_access bigint, n_hex bigint, "
    "base_sha256 string, spans array<struct<start:bigint,kind:int,end:bigint,value:binary,random:boolean>>"
)


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str) -> DataFrame:
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{owner_col}`").cast("string").alias("owner"),
        F.col(f"`{repository_col}`").cast("string").alias("repository"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in strings(batch.column(4)):
                base = base_spans(text)
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(
                    [
                        {
                            "start": start,
                            "kind": kind,
                            "end": end,
                            "value": hashlib.sha256(value.encode()).digest(),
                            "random": entropy(value) >= RANDOM_BITS,
                        }
                        for start, kind, end, value in sorted(base + mixed_spans(text, base))
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in range(4)),
                    *(pa.array(n, pa.int64()) for n in counts),
                    pa.array(digests, pa.string()),
                    pa.array(spans, SCANNED.field("spans").type),
                ],
                schema=SCANNED,
            )

    return small_batches(source).mapInArrow(run, SCANNED_SQL)


def ownership(candidates: DataFrame) -> DataFrame:
    """(value, n_repositories, n_owners) of each distinct value."""
    return (
        candidates.select("value", "owner", "repository")
        .distinct()
        .groupBy("value", "owner")
        .agg(F.count("*").alias("n"))
        .groupBy("value")
        .agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))
    )


def find_secrets(
    docs: DataFrame,
    copied_owners: int = 3,
    copied_repositories: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_copied, n_live, n_owners, n_repositories) per row of `docs`.

    `spans` lists kind:start:end of all spans; n_copied counts those whose value `copied_owners` owners or
    `copied_repositories` repositories or more hold, n_live the others that look random. n_owners and n_repositories
    are those of the most widely held value of the row's spans, 0 without spans.
    """
    scanned = materialize(scan(docs, id_col, text_col, owner_col, repository_col), "scanned")
    candidates = scanned.where(F.size("spans") > 0).select("row", "owner", "repository", F.inline("spans"))
    counts = ownership(candidates)
    copied = (F.col("n_owners") >= copied_owners) | (F.col("n_repositories") >= copied_repositories)
    live = ~copied & F.col("random")
    judged = candidates.join(counts, "value").withColumn("copied", copied).withColumn("live", live)
    judged = judged.where((F.col("kind") < KINDS.index("mixed")) | F.col("live"))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    lists = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", label.alias("label")))).alias("found"),
        F.sum(F.col("copied").cast("long")).alias("n_copied"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.max("n_owners").alias("n_owners"),
        F.max("n_repositories").alias("n_repositories"),
    )
    return scanned.drop("spans").join(lists, "row", "left").select(
        "id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.coalesce(F.array_join(F.col("found.label"), ","), F.lit("")).alias("spans"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_owners", "n_repositories")],
    )
