"""Stupid-backoff language-model scores over n-gram count tables.

A word's score is ``c(context word) / c(context)`` for the longest context (up to
``order - 1`` words) with which it occurs in another document, times ``BACKOFF`` for
each word that the context was shortened by. Counts are those of all documents less
those of the scored document itself, so that no document vouches for its own
n-grams; a word that no other document has counts as seen once.

1. Documents are dealt into chunks by hash. A chunk explodes its n-grams of each
   order, and sends every distinct one with its count to the partition of its hash.
   Rows are packed: a chunk's n-grams of one hash range are one row of sorted,
   difference-coded hashes of ``HASH_BITS`` bits.
2. The count tables are summed per hash range, joined back to the n-grams that each
   chunk sent, and returned in their order.
3. Each chunk looks up its documents' n-grams and sums the logarithms per document.

A frequent n-gram is one entry per chunk, whatever the number of documents that hold
it; chunks and hash ranges have a bounded size and their number grows with the input.

Words are ASCII-white-space-separated and lower-cased (A-Z). Defined cases: texts without
words (null too) have no words, score 0 and no mean; repeated rows and equal ids are separate
documents; in a single document every word counts as seen once; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import text_or_empty
from archivesearch.llm.hashing import U, hashed_words, mix, sequences

BACKOFF = 0.4
CHUNK_BYTES = 6_000_000
RANGE_GRAMS = 1_500_000
#: The n-gram of no words; its count is the number of words.
HASH_BITS = 56  # n distinct n-grams have n * n / 2**57 colliding pairs on average
EMPTY = mix(np.array([0x5EED], dtype=U))[0] >> U(64 - HASH_BITS)


def squeeze(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True)


def pack_sorted(h: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct integers as differences, byte by byte, of as few bytes as the largest needs."""
    steps = np.diff(h, prepend=U(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return width, squeeze(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def unpack_sorted(n: int, width: int, packed: bytes) -> np.ndarray:
    raw = pa.decompress(packed, decompressed_size=n * width, codec="zstd", asbytes=True)
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=U)


def pack_counts(n: np.ndarray) -> tuple[bytes, bytes]:
    """A byte each; counts of 255 and more follow in full."""
    return squeeze(np.minimum(n, 255).astype(np.uint8).tobytes()), n[n >= 255].astype("<u8").tobytes()


def unpack_counts(size: int, small: bytes, large: bytes) -> np.ndarray:
    raw = pa.decompress(small, decompressed_size=size, codec="zstd", asbytes=True)
    n = np.frombuffer(raw, np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(large, "<u8").astype(np.int64)
    return n


def grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words of each text, its number, and per order the n-gram that starts at each word (0 where none fits)."""
    words, counts = hashed_words(texts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))  # words from here to the text's end
    found = []
    for k in range(1, order + 1):
        h = np.zeros(len(words), dtype=U)
        own = sequences(words, k)
        fits = left[:len(own)] >= k
        h[:len(own)][fits] = own[fits] >> U(64 - HASH_BITS)
        found.append(h)
    return counts, np.repeat(np.arange(len(texts)), counts), found


SENT = "chunk bigint, hash_range bigint, n int, width int, hashes binary, small binary, large binary"
_SENT = pa.schema([("chunk", pa.int64()), ("hash_range", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("hashes", pa.binary()),
                   ("small", pa.binary()), ("large", pa.binary())])


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * len(_SENT)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _SENT.types)], schema=_SENT)


def chunk_counter(order: int, range_bits: int):
    def count(table: pa.Table) -> pa.Table:
        _, _, found = grams(table.column("body").to_pylist(), order)
        every = np.concatenate(found)
        h, n = np.unique(every[every != 0], return_counts=True)
        at = int(np.searchsorted(h, EMPTY))
        h, n = np.insert(h, at, EMPTY), np.insert(n, at, len(found[0]))
        chunk = table.column("chunk")[0].as_py()
        base = np.arange(1 << range_bits, dtype=U) << U(HASH_BITS - range_bits)
        cuts = np.searchsorted(h, base[1:])
        rows = [(chunk, r, len(x), *pack_sorted(x - base[r]), *pack_counts(c))
                for r, (x, c) in enumerate(zip(np.split(h, cuts), np.split(n, cuts))) if len(x)]
        return _table(rows)

    return count


def sum_range(table: pa.Table) -> pa.Table:
    """Totals of one hash range, in the order in which each chunk sent its n-grams."""
    rows = table.to_pylist()
    sent = [unpack_sorted(r["n"], r["width"], r["hashes"]) for r in rows]
    counts = np.concatenate([unpack_counts(r["n"], r["small"], r["large"]) for r in rows])
    _, place = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.bincount(place, weights=counts).astype(np.int64)[place]
    own = np.split(totals, np.cumsum([len(s) for s in sent])[:-1])
    return _table([(r["chunk"], r["hash_range"], r["n"], 0, b"", *pack_counts(t)) for r, t in zip(rows, own)])


RESULT = "id bigint, n_words bigint, n_backed_off bigint, log_score double"


def scorer(order: int):
    def score(docs: pa.Table, replies: pa.Table) -> pa.Table:
        counts, owner, found = grams(docs.column("body").to_pylist(), order)
        every = np.concatenate([*found, np.array([EMPTY])])
        uniq, place = np.unique(every, return_inverse=True)
        skip = int(len(uniq) > 0 and uniq[0] == 0)
        rows = sorted(replies.select(["hash_range", "n", "small", "large"]).to_pylist(), key=lambda r: r["hash_range"])
        totals = np.zeros(len(uniq), dtype=np.int64)
        if rows:
            totals[skip:] = np.concatenate([unpack_counts(r["n"], r["small"], r["large"]) for r in rows])
        n, words = len(owner), int(totals[place[-1]])
        others = []  # per order: occurrences in other documents of the n-gram that starts at each word
        for k in range(order):
            at = place[k * n:(k + 1) * n]
            _, own_at, own = np.unique(owner * np.int64(len(uniq)) + at, return_inverse=True, return_counts=True)
            others.append(totals[at] - own[own_at])
        rest = np.maximum(words - counts[owner], 1)  # words of other documents
        first = np.cumsum(counts) - counts
        spot = np.arange(n) - first[owner] if n else np.empty(0, np.int64)
        value = np.log(np.maximum(others[0], 1) / rest) if n else np.empty(0)
        used = np.ones(n, dtype=np.int64)
        for k in range(2, order + 1):
            ends = np.arange(k - 1, n)
            fits = spot[ends] >= k - 1
            ends = ends[fits]
            c, context = others[k - 1][ends - k + 1], others[k - 2][ends - k + 1]
            seen = c > 0
            value[ends[seen]] = np.log(c[seen] / context[seen])
            used[ends[seen]] = k
        steps = np.minimum(spot + 1, order) - used
        value += steps * math.log(BACKOFF)
        sums = np.bincount(owner, weights=value, minlength=len(counts))
        backed = np.bincount(owner, weights=steps > 0, minlength=len(counts)).astype(np.int64)
        return pa.table({"id": docs.column("id"), "n_words": pa.array(counts, pa.int64()),
                         "n_backed_off": pa.array(backed, pa.int64()), "log_score": pa.array(sums, pa.float64())})

    return score


def backoff_scores(docs: DataFrame, order: int = 3, doc_id: str = "doc_id", text: str = "text",
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """:data:`RESULT` for each row of ``docs``."""
    spark = docs.sparkSession
    body = text_or_empty(text)
    size = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    range_bits = max(0, math.ceil(math.log2(max(1, size / 6 * order / RANGE_GRAMS))))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col(doc_id).cast("bigint").alias("id"), body.alias("body"),
                        F.pmod(F.xxhash64(F.col(doc_id), body), F.lit(chunks)).alias("chunk")).repartition(partitions, "chunk")
    replies = dealt.groupBy("chunk").applyInArrow(chunk_counter(order, range_bits), SENT).groupBy(
        "hash_range").applyInArrow(sum_range, SENT)
    return dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(scorer(order), RESULT)
