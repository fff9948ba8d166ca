"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

1. Documents are tokenised in Arrow batches, each distinct word of a chunk once; a document longer
   than ``capacity`` is cut into pieces of that length.
2. Pieces are dealt by hash into groups of about ``group_items`` and each group
   is packed best-fit decreasing. Bins at least ``full`` of the capacity are
   final; the others go up the tree as items of their fill.
3. Rounds repeat with fewer groups until one group remains or a round joins no
   bins. A round's result is a small table ``bin -> parent bin, shift``; the
   pieces take their final place by joins with these tables.

Defined cases: a null text is empty and yields the closing id alone; equal ids
or repeated rows are packed as separate pieces; ties in length are ordered by
id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import kept_in_worker, lean, small_batches, stage, text_or_empty
from archivesearch.llm.hashing import hashed_spans

PIECES = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

WIDTH = 8  # ids of a word that the table of words holds; longer words are encoded anew in each chunk


class WordIds:
    """The ids of words by a 64-bit hash of the word: a table of ``2**bits`` rows (25 bytes each, 41 for vocabularies
    beyond 65,536), in which a word takes the place of one with equal last bits of the hash."""

    def __init__(self, tokenizer_path: str, bits: int = 20) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.last = np.uint64((1 << bits) - 1)
        self.key = np.zeros(1 << bits, dtype=np.uint64)
        self.size = np.zeros(1 << bits, dtype=np.int8)
        self.ids = np.zeros((1 << bits, WIDTH), dtype="<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def encode(self, words: list[str], part: int = 1 << 12) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has; few calls, for the tokenizer keeps the
        memory that its longest input took."""
        ids, sizes = [], []
        for at in range(0, len(words), part):
            some = words[at:at + part]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded.offsets))
            to = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in some]))
            ids.append(np.array(encoded.ids, dtype="<u4"))
            sizes.append(np.diff(to, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    def of(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has. ``starts`` and ``ends``: the words' places in ``raw``."""
        slot = (keys & self.last).astype(np.int64)
        known = (self.key[slot] == keys) & (self.size[slot] > 0)
        size = np.where(known, self.size[slot], 0).astype(np.int64)
        new = np.flatnonzero(~known)
        fresh = np.empty(0, "<u4")
        if len(new):
            fresh, size[new] = self.encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist())])
        first = np.cumsum(size) - size
        ids = np.empty(int(size.sum()), dtype="<u4")
        old = np.flatnonzero(known)
        row, column = _expand(size[old])
        ids[first[old][row] + column] = self.ids[slot[old][row], column]
        row, column = _expand(size[new])
        ids[first[new][row] + column] = fresh
        short = new[(size[new] > 0) & (size[new] <= WIDTH)]
        for k in range(WIDTH):
            some = short[size[short] > k]
            self.ids[slot[some], k] = ids[first[some] + k]
        self.key[slot[short]], self.size[slot[short]] = keys[short], size[short]
        # two new words of one place: the last one's key stays, so its ids must
        clash = short[self.key[slot[short]] != keys[short]]
        self.size[slot[clash]] = 0
        return ids, size


def _expand(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, place in the row)`` of every element of rows of the given sizes."""
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)


def word_ids(tokenizer_path: str) -> WordIds:
    """One table in a Python worker."""
    return kept_in_worker(f"word ids {tokenizer_path} {os.getpid()}", lambda: WordIds(tokenizer_path))


def encode_texts(texts: list[str], tokenizer_path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers.

    The tokenizer's rules never join characters across ASCII white space, so a text's ids are
    those of its white-space-separated words. Equal words of the texts meet by their 64-bit hashes.
    """
    if not texts:
        return []
    words, starts, ends, raw, counts = hashed_spans(texts, lower=False)
    keys, first, which = np.unique(words, return_index=True, return_inverse=True)
    ids, size = word_ids(tokenizer_path).of(keys, starts[first], ends[first], raw.tobytes())
    at = (np.cumsum(size) - size)[which]
    row, column = _expand(size[which])
    flat = ids[at[row] + column].tobytes()
    upto = np.append(0, np.cumsum(size[which]))[np.append(0, np.cumsum(counts))].tolist()
    return [flat[4 * a:4 * b] for a, b in zip(upto, upto[1:])]


def chunks(texts: list[str], size: int = 1 << 17) -> Iterator[slice]:
    """Runs of texts of about ``size`` characters."""
    at = 0
    while at < len(texts):
        to, n = at, 0
        while to < len(texts) and (to == at or n + len(texts[to]) < size):
            n += len(texts[to])
            to += 1
        yield slice(at, to)
        at = to


def cut_pieces(batches: Iterator[pa.RecordBatch], tokenizer_path: str, capacity: int, end_id: int,
               ) -> Iterator[pa.RecordBatch]:
    end = array("I", [end_id]).tobytes()
    for batch in lean(batches):
        docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for part in chunks(texts):
            rows = []
            for doc, ids in zip(docs[part], encode_texts(texts[part], tokenizer_path)):
                ids += end
                for k, b in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[b:b + 4 * capacity]
                    rows.append((doc, k, b // 4, len(piece) // 4, zlib.crc32(piece)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["id", "piece", "start", "length", "ids_crc32"])


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                     doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("bigint").alias("id"), text_or_empty(text).alias("body")).mapInArrow(
        lambda it: cut_pieces(it, tokenizer_path, capacity, end_id), PIECES)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item in the given order, and the fill of each bin."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    mask = 0  # bit r is set if some bin has r left
    bins, offsets, fill = [], [], []
    for n in lengths:
        fits = mask >> n << n
        if fits:
            room = (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins.append(b)
        offsets.append(fill[b])
        fill[b] += n
        if room > n:
            free[room - n].append(b)
            mask |= 1 << (room - n)
    return bins, offsets, fill


def group_packer(round_no: int, capacity: int, order: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", *order], ascending=[False] + [True] * len(order), kind="stable")
        bins, offsets, fill = best_fit(pdf["length"].tolist(), capacity)
        first = (round_no << 56) | (int(pdf["grp"].iloc[0]) << 24)  # a group holds far fewer than 2**24 bins
        return pdf.assign(bin=[first + b for b in bins], shift=offsets, fill=[fill[b] for b in bins]).drop(columns="grp")

    return packed


def pack(pieces: DataFrame, capacity: int = 4096, group_items: int = 8192, full: float = 0.999) -> DataFrame:
    """``pieces`` (see :data:`PIECES`) with ``sequence_id`` and ``offset``."""
    pieces = stage(pieces, "pieces")
    groups = max(1, math.ceil(pieces.count() / group_items))
    key = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(groups)).alias("grp")
    schema = PIECES + ", bin bigint, shift bigint, fill bigint"
    placed = stage(pieces.select("*", key).groupBy("grp").applyInPandas(
        group_packer(0, capacity, ["id", "piece", "ids_crc32"]), schema), "placed")
    at = placed.select("id", "piece", "start", "length", "ids_crc32", "bin", F.col("shift").alias("offset"))
    under = placed.where(F.col("fill") < full * capacity).groupBy("bin").agg(F.max("fill").alias("length"))
    left, round_no = under.count(), 0
    # a round gathers the underfull bins of many groups into fewer groups
    while groups > 1 and left > 1:
        round_no += 1
        groups = math.ceil(left / group_items)
        moved = stage(under.select("bin", "length", F.pmod(F.xxhash64("bin"), F.lit(groups)).alias("grp"))
                      .withColumnRenamed("bin", "child").groupBy("grp").applyInPandas(
            group_packer(round_no, capacity, ["child"]),
            "child bigint, length bigint, bin bigint, shift bigint, fill bigint"), f"round{round_no}")
        step = moved.select("child", F.col("bin").alias("parent"), F.col("shift").alias("moved_by"))
        at = at.join(step, F.col("bin") == F.col("child"), "left").select(
            "id", "piece", "start", "length", "ids_crc32", F.coalesce("parent", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("moved_by", F.lit(0))).alias("offset"))
        under = moved.where(F.col("fill") < full * capacity).groupBy("bin").agg(F.max("fill").alias("length"))
        before, left = left, under.count()
        if moved.select("bin").distinct().count() == before:
            break  # no two bins fit together any more
    return at.withColumnRenamed("bin", "sequence_id")
