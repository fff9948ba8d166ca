"""Secret scanning with multipart credential linking.

1. A small per-text scanner lists spans: base findings (``assign``, ``access``,
   ``hex``) and weak parts: 40-character mixed tokens that no keyword names
   (``key``), and endpoints with a scheme or a service host (``endpoint``).
2. Weak parts are linked by an interval join within scopes. A scope is a run of
   ``reach`` code points to either side of a part. Parts are sorted by position
   within their document and each meets the nearest complementary part on either
   side (an as-of join by window functions, so no pair of all parts is formed).
3. A weak ``key`` is reported as ``secret`` only where an access identifier lies
   in its scope, an ``endpoint`` only where both an access identifier and a secret
   (assign, or a linked key) do.

Base findings are always reported. Defined cases: a null text is empty; equal
ids are separate documents; parts that touch count as distance 0; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivesearch.llm.common import stage, text_or_empty

#: Fixed patterns of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
#: Weak parts: report nothing by themselves.
KEY = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")  # after '=' too, as in .env files
ENDPOINT = re.compile(r"\b(?:https?|s3|jdbc|postgres|mysql|redis|amqp|mongodb)://[^\s\"'<>]+", re.ASCII)

KINDS = ["assign", "access", "hex", "secret", "endpoint"]
BASE = 3  # the first kinds
SPANS = "array<struct<kind:int,start:int,end:int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(2, *m.span()) for m in HEX_LONG.finditer(text)]


def weak_parts(text: str) -> list[tuple[int, int, int]]:
    """Unnamed 40-character tokens with digits and both cases, and endpoints."""
    found = []
    for m in KEY.finditer(text):
        t = m.group()
        if any(c.isdigit() for c in t) and any(c.islower() for c in t) and any(c.isupper() for c in t):
            found.append((3, *m.span()))
    if "://" in text:
        found += [(4, *m.span()) for m in ENDPOINT.finditer(text)]
    return found


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the weak parts that do not lie within one of them."""
    base = base_spans(text)
    if not any(kind == 1 for kind, _, _ in base):
        return base, []  # nothing can be linked without an access identifier
    by_start = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in by_start], [*accumulate((e for _, e in by_start), max)]

    def within(start: int, end: int) -> bool:
        k = bisect_right(starts, start)
        return k > 0 and reach[k - 1] >= end

    return base, [p for p in weak_parts(text) if not within(p[1], p[2])]


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, row, base, weak)`` for each row of ``docs``."""
    kinds = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def spans(found: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found], kinds)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [scan(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), spans([b for b, _ in both]), spans([w for _, w in both])],
                names=["id", "row", "base", "weak"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"),
                       text_or_empty(text).alias("body"))
    return rows.mapInArrow(scanned, f"id bigint, row bigint, base {SPANS}, weak {SPANS}")


def link(parts: DataFrame, reach: int = 400) -> DataFrame:
    """The weak parts of ``(row, kind, start, end)`` that complementary parts in their scope support."""

    def near(frame: DataFrame, kinds: list[int], name: str) -> DataFrame:
        """Whether a part of these kinds lies within ``reach`` of each part."""
        here = F.col("kind").isin(kinds)
        order = Window.partitionBy("row").orderBy("start", "end", "kind")
        before = F.max(F.when(here, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        after = F.min(F.when(here, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
        close = (F.col("start") - before <= reach) | (after - F.col("end") <= reach)
        return frame.withColumn(name, F.coalesce(close, F.lit(False)))

    keys = near(parts, [1], "access_near").where("kind != 3 OR access_near")
    return near(keys, [0, 3], "secret_near").where("kind = 3 OR (kind = 4 AND access_near AND secret_near)").select(
        "row", "kind", "start", "end")


def find_secrets(docs: DataFrame, reach: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, row, base, spans)`` for each row of ``docs``; spans are sorted by start, then kind."""
    scanned = stage(scan_documents(docs, doc_id, text), "scanned")
    parts = scanned.where(F.size("weak") > 0).select("row", F.explode(F.concat("base", "weak")).alias("p")).select(
        "row", "p.kind", "p.start", "p.end")
    linked = link(parts, reach).groupBy("row").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("linked"))  # of one document
    by_start = "transform(array_sort(transform({}, x -> struct(x.start, x.kind, x.end))), x -> struct(x.kind, x.start, x.end))"
    return scanned.join(linked, "row", "left").select(
        "id", "row", F.expr(by_start.format("base")).alias("base"),
        F.expr(by_start.format(f"concat(base, coalesce(linked, cast(array() as {SPANS})))")).alias("spans"))


def joined(spans: str):
    """``kind:start:end``, comma-joined."""
    names = ",".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', array({names})[x.kind], x.start, x.end)), ',')")
