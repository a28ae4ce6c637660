"""Secrets in text, told apart by how widely each value is copied over the corpus.

Every value that looks like a credential is a candidate.  Candidate hashes are counted over the
whole corpus by distinct repositories and distinct owners.  A value of at most ``LIVE_OWNERS``
owner that looks random is live; one with at least ``EXAMPLE_OWNERS`` owners is a widely copied
example; the rest is unclear.  Base spans are always reported; bare high-entropy values
(kind ``bare``) are reported only when the counts say they are live.

Null texts count as empty and have no spans.  A null repository or owner counts as one of its
own.  Repeated rows each get their spans and do not raise the counts, which are of distinct
repositories and owners.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.shared import stored

LIVE_OWNERS, EXAMPLE_OWNERS = 1, 3
MIN_ENTROPY = 3.0  # bits per character of a value that looks random
KINDS = ("assign", "access", "hex", "bare")

# The patterns and lengths of the base kinds.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
MIN_ASSIGNED = 6

BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your[_-]|x{4,}|0{6,}|1234", re.IGNORECASE)


def looks_random(value: str) -> bool:
    counts, n = Counter(value).values(), len(value)
    bits = -sum(c / n * math.log2(c / n) for c in counts)
    return bits >= MIN_ENTROPY and any(c.isdigit() for c in value) and not PLACEHOLDER.search(value)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of base spans and of bare values outside them, in order."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    # Base spans by start, with the furthest end so far: one look tells whether any overlaps.
    covered = sorted((start, end) for start, _, end, _ in found)
    starts, furthest = [s for s, _ in covered], list(accumulate((e for _, e in covered), max))
    for m in BARE.finditer(text):
        value = m[0]
        if (any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)
                and not ((k := bisect_left(starts, m.end())) and furthest[k - 1] > m.start())):
            found.append((m.start(), 3, m.end(), value))
    return sorted(found)


SCANNED = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value_hash", pa.binary()),
                     ("random", pa.bool_())])


def scan_texts(docs: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """One row per document: the columns ``keep`` and its candidates, without the text."""
    chosen = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(f"`{text}`").alias("_text"))

    names = [*keep, "found"]

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            spans = []
            for value in batch.column(batch.num_columns - 1):
                spans.append([
                    {"start": s, "kind": k, "end": e, "value_hash": hashlib.sha256(v.encode()).digest()[:16],
                     "random": looks_random(v)}
                    for s, k, e, v in candidates(value.as_py() or "")
                ])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(spans, pa.list_(SCANNED))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    span = "struct<start: bigint, kind: int, end: bigint, value_hash: binary, random: boolean>"
    return chosen.mapInArrow(scan, f"{fields}, found array<{span}>")


def owner_counts(scanned: DataFrame) -> DataFrame:
    """Per candidate hash: in how many repositories and with how many owners it occurs."""
    seen = scanned.select("repository", "owner", F.explode("found.value_hash").alias("value_hash"))
    null = F.lit("\0")
    return seen.groupBy("value_hash").agg(
        F.count_distinct(F.coalesce("repository", null)).alias("repositories"),
        F.count_distinct(F.coalesce("owner", null)).alias("owners"),
    )


def find_secrets(docs: DataFrame, doc_id: str, text: str, repository: Column, owner: Column) -> DataFrame:
    """One row per document: doc_id and spans, an array of (start, kind, end, state), in order.

    ``state`` is live, example or unclear.  The texts are scanned once; what was found is
    stored, counted by value and joined back by value.
    """
    found = stored(scan_texts(docs, text, {
        "doc_id": F.col(f"`{doc_id}`"), "repository": repository, "owner": owner,
        "row_id": F.monotonically_increasing_id(),
    }))
    one = found.where(F.size("found") > 0).select("row_id", F.explode("found").alias("s")).select("row_id", "s.*")
    state = (
        F.when((F.col("owners") <= LIVE_OWNERS) & F.col("random"), "live")
        .when(F.col("owners") >= EXAMPLE_OWNERS, "example").otherwise("unclear")
    )
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    judged = one.join(owner_counts(found), "value_hash").withColumn("state", state)
    judged = judged.where((F.col("kind") < 3) | (F.col("state") == "live"))
    # A document's spans come together: as many as its own text holds.
    spans = judged.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.col("kind").alias("order"), kind.alias("kind"), "end", "state"))).alias("spans"))
    empty = F.array().cast("array<struct<start: bigint, order: int, kind: string, end: bigint, state: string>>")
    return found.select("row_id", "doc_id").join(spans, "row_id", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``text`` with every span replaced; overlapping spans are replaced as one."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_column(mask: str):
    @F.arrow_udf("string")
    def masks(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([
                None if t.as_py() is None else masked(t.as_py(), [tuple(s.values()) for s in found.as_py() or ()], mask)
                for t, found in zip(texts, spans, strict=True)], pa.string())

    return masks
