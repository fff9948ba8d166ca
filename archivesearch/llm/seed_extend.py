"""Substring deduplication by seed and extend, on words.

A repeat is a run of at least ``LENGTH`` words that also starts in a document with a smaller id.

1. Seeds: winnowing picks in each window of ``LENGTH`` words the ``SEED``-word run of smallest
   hash (the last one of a tie) as its anchor, so equal windows have the same anchor at the same
   place. One row per anchor stands for all the windows that chose it, about two in nine words.
2. Documents meet on the anchors' hash. Rows whose whole surroundings (all of the row's windows)
   stand in a document with a smaller id are repeats at once; within an Arrow batch such rows are
   marked before anything is shuffled, so a passage that a third of the documents share sends one
   row per batch and anchor. Anchors of one document only leave.
3. Extend: of the other rows (the ends of repeats, and anchors that meet by chance) the words around
   the anchor are fetched. Each row is joined with the first row (smallest id) of its anchor, and the
   match is extended word by word to both sides. A window inside the match is resolved: the first
   row's document is the first that has it. Rows with unresolved windows go on with the anchor
   lengthened by the word at which the match ended, so they meet only rows that share it.
   Rounds end when no window is left, after at most ``LENGTH - SEED + 1`` of them but for hash
   collisions, which the extension finds and deals out under another hash. No pairs within a
   group are made: a row meets one other row in each round.
4. The windows found overlap or touch along a repeat; their union gives the maximal repeats, which
   are cut out.

Anchors, surroundings and words are compared by 64-bit hashes.

Defined cases: a null text has no words; texts of fewer than ``LENGTH`` words lose nothing; repeats
within one document, or between rows of equal id, are no repeats; equal rows get equal results; a
null id counts as the smallest; a very long text is read in blocks; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivesearch.llm.common import small_batches, stage, text_or_empty
from archivesearch.llm.hashing import ODD, U, hashed_words, mix, sequences

LENGTH, SEED = 13, 5
REACH = LENGTH - SEED  # words beside an anchor, to one side, that a window can hold
CHUNK = 1 << 20
ANCHORS = "seed bigint, full bigint, id bigint, body bigint, place bigint, known boolean"
NAMES = ["key", "id", "body", "start", "before", "todo", "a", "b", "ctx"]
LIVE = "key bigint, id bigint, body bigint, start bigint, before int, todo int, a int, b int, ctx binary"
RESULT = "id bigint, doc_id bigint, n_words bigint, removed array<struct<start:bigint,end:bigint>>, kept string"


def segments(text: str) -> Iterator[str]:
    """Parts of about ``CHUNK`` characters, cut at white space."""
    at = 0
    while len(text) - at > CHUNK:
        to = at + CHUNK
        while to < len(text) and text[to] not in " \t\n\v\f\r":
            to += 1
        yield text[at:to]
        at = to
    yield text[at:]


def word_blocks(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, word hashes, words of each text)`` of runs of texts of about ``CHUNK`` characters."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < CHUNK):
            size += len(texts[to])
            to += 1
        if size > CHUNK:
            words = np.concatenate([hashed_words([s], lower=False)[0] for s in segments(texts[at])])
            yield at, words, np.array([len(words)])
        else:
            yield at, *hashed_words(texts[at:to], lower=False)
        at = to


def anchors(words: np.ndarray, counts: np.ndarray, block: int = 1 << 18) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, first window, windows, words of the first window before the anchor, seed, full)`` of each anchor."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first_word = np.cumsum(counts) - counts
    for lo in range(0, max(0, len(words) - LENGTH + 1), block):
        part = words[lo:lo + block + LENGTH - 1]
        grams, m = sequences(part, SEED), len(part) - LENGTH + 1
        best, at = grams[:m].copy(), np.arange(m)
        for o in range(1, REACH + 1):
            lower = grams[o:o + m] <= best
            np.copyto(best, grams[o:o + m], where=lower)
            np.copyto(at, np.arange(o, o + m), where=lower)
        j = np.flatnonzero(owner[lo:lo + m] == owner[lo + LENGTH - 1:lo + LENGTH - 1 + m])
        if not len(j):
            continue
        turn = np.flatnonzero((at[j[1:]] != at[j[:-1]]) | (j[1:] != j[:-1] + 1)) + 1
        start, end = j[np.append(0, turn)], j[np.append(turn, len(j)) - 1]
        window, before = sequences(part, LENGTH), at[start] - start
        full = mix((mix(window[start]) ^ window[end]) * ODD + (end - start).astype(U) * U(64) + before.astype(U))
        text = owner[lo + start]
        yield text, lo + start - first_word[text], end - start + 1, before, grams[at[start]], full


def known_rows(seed: np.ndarray, full: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask of the rows whose surroundings a row of smaller id in this batch has."""
    order = np.lexsort((ids, full, seed))
    s, f, i = seed[order], full[order], ids[order]
    new = np.append(True, (s[1:] != s[:-1]) | (f[1:] != f[:-1]))
    least = i[np.flatnonzero(new)][np.cumsum(new) - 1]
    mask = np.empty(len(seed), bool)
    mask[order] = i > least
    return mask


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids, bodies = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        out = []
        for first, words, counts in word_blocks(batch.column(2).to_pylist()):
            for text, start, windows, before, seed, full in anchors(words, counts):
                row = first + text
                out.append((seed, full, ids[row], bodies[row], (start << 8) | (before << 4) | windows))
        if not out:
            continue
        seed, full, id_, body, place = (np.concatenate(c) for c in zip(*out))
        known = known_rows(seed, full, id_)
        # a known row needs no partner: a key of its own spreads it
        seed = np.where(known, mix(seed ^ mix(id_.astype(U) * ODD + place.astype(U))), seed)
        for at in range(0, len(seed), 1 << 16):
            cut = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[cut]) for c in (seed.view(np.int64), full.view(np.int64), id_, body, place, known)],
                names=["seed", "full", "id", "body", "place", "known"])


def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the windows that each wanted anchor stands for (see :data:`LIVE`)."""
    for batch in slices(batches):
        ids, bodies = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        many = batch.column(3).value_lengths().to_numpy()
        upto = np.append(0, np.cumsum(many))
        wanted = batch.column(3).flatten()
        seed, place, leads = (wanted.field(n) for n in ("seed", "place", "leads"))
        place = place.to_numpy()
        for first, words, counts in word_blocks(batch.column(2).to_pylist()):
            lo, hi = upto[first], upto[first + len(counts)]
            text = np.repeat(np.arange(len(counts)), many[first:first + len(counts)])
            start, before, windows = place[lo:hi] >> 8, place[lo:hi] >> 4 & 15, place[lo:hi] & 15
            size = windows + LENGTH - 1
            end = np.cumsum(size)
            at = np.repeat((np.cumsum(counts) - counts)[text] + start - (end - size), size) + np.arange(size.sum())
            ctx = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((8 * np.append(0, end)).astype(np.int32).tobytes()),
                                                               pa.py_buffer(words[at].tobytes())])
            nought = np.zeros(hi - lo, np.int32)
            yield pa.RecordBatch.from_arrays(
                [seed.slice(lo, hi - lo), *map(pa.array, (ids[first + text], bodies[first + text], start, before.astype(np.int32),
                 ((1 << windows) - 1).astype(np.int32), nought, nought)), ctx, leads.slice(lo, hi - lo)], names=[*NAMES, "leads"])


def aligned(ctx: pa.Array, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of a matrix in which all anchors stand at column ``REACH``, and a mask of the words there are."""
    offset = np.frombuffer(ctx.buffers()[1], np.int32)[ctx.offset:ctx.offset + len(ctx) + 1]
    size = np.diff(offset) // 8
    row = np.repeat(np.arange(len(ctx)), size)
    column = np.arange(len(row)) + np.repeat(REACH - before - (np.cumsum(size) - size), size)
    words = np.zeros((len(ctx), LENGTH + REACH), dtype=U)
    there = np.zeros(words.shape, bool)
    words[row, column] = np.frombuffer(ctx.buffers()[2], np.uint8)[offset[0]:offset[-1]].view("<u8")
    there[row, column] = True
    return words, there


def extended(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
    """Rows joined with the first row of their key: windows found in a smaller document (``ctx`` null, as
    ``todo``), and what is left of the row under a longer key."""
    for batch in slices(batches, 4096):
        col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        num = {n: col[n].to_numpy(zero_copy_only=False) for n in ("id", "body", "start", "before", "todo", "a", "b", "f_id", "f_before")}
        mine, there = aligned(col["ctx"], num["before"])
        other, also = aligned(col["f_ctx"], num["f_before"])
        same = (mine == other) & there & also
        left = np.cumprod(same[:, REACH - 1::-1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, REACH + SEED:], axis=1).sum(axis=1)
        met = same[:, REACH:REACH + SEED].all(axis=1) & (left >= num["a"]) & (right >= num["b"])  # else their hashes collide
        found, to_left, to_right = (np.zeros(len(mine), np.int32) for _ in range(3))
        for w in range(REACH + 1):
            bit = num["todo"] & (1 << w)
            o = num["before"] - w  # words of this window before the anchor
            inside = met & (o <= left) & (REACH - o <= right)
            found |= np.where(inside, bit, 0).astype(np.int32)
            to_left |= np.where(~inside & (~met | (o > left)), bit, 0).astype(np.int32)
            to_right |= np.where(~inside & met & (o <= left), bit, 0).astype(np.int32)
        found = np.where(num["f_id"] < num["id"], found, 0)  # else no smaller document has them
        total = np.zeros((len(mine), mine.shape[1] + 1), dtype=U)
        np.cumsum(mix(mine + np.arange(mine.shape[1], dtype=U) * ODD), axis=1, out=total[:, 1:])
        salt = mix(np.full(1, turn + 1, dtype=U))
        hit = np.flatnonzero(found)
        nought = np.zeros(len(hit), np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (nought.astype(np.int64), *(num[n][hit] for n in ("id", "body", "start", "before")), found[hit],
                                   nought, nought)] + [pa.nulls(len(hit), pa.binary())], names=NAMES)
        for todo, a, b in ((to_left, np.where(met, left + 1, num["a"]), num["b"]), (to_right, num["a"], right + 1)):
            on = np.flatnonzero(todo)
            text = total[on, REACH + SEED + b[on]] - total[on, REACH - a[on]]
            key = mix(text + a[on].astype(U) * U(1 << 20) + b[on].astype(U) * U(1 << 30) + salt).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (key, *(num[n][on] for n in ("id", "body", "start", "before")), todo[on],
                                       a[on].astype(np.int32), b[on].astype(np.int32))] + [col["ctx"].take(pa.array(on))], names=NAMES)


def resolve(live: DataFrame) -> DataFrame:
    """``(id, body, start, todo)``: of the rows of ``live`` (see :data:`LIVE`, and ``leads``: the first of its
    key), the windows that a document with a smaller id has.

    From the second round on, rows whose key is in one document only leave before their words move."""
    found, lead = None, live.where("leads")
    for turn in range(4 * LENGTH):
        first = stage(lead.groupBy("key").agg(F.min(F.struct("id", "body", "start", "before", "ctx")).alias("f")).select(
            "key", F.col("f.id").alias("f_id"), F.col("f.before").alias("f_before"), F.col("f.ctx").alias("f_ctx")), "leads")
        out = stage(live.join(first, "key").select(*NAMES, "f_id", "f_before", "f_ctx")
                    .mapInArrow(lambda it, turn=turn: extended(it, turn), LIVE), f"extended{turn}")
        hits = out.where("ctx IS NULL").select("id", "body", "start", "todo")
        found = hits if found is None else found.unionAll(hits)
        left = out.where("ctx IS NOT NULL")
        shared = stage(left.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
                       .select("key"), "shared")
        if shared.isEmpty():
            return found
        live = lead = stage(left.join(shared, "key", "left_semi"), f"live{turn}")
    raise RuntimeError("windows are left after all rounds")


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without the words of its repeats; ``spots`` are first words of windows, times 512, and masks."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = []
            for text, spots in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                words, spans = text.encode("utf-8", "surrogatepass").split(), []
                if spots:
                    spot = np.array(spots, dtype=np.int64)
                    windows = [(spot >> 9)[(spot >> w & 1) == 1] + w for w in range(REACH + 1)]
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    for w in windows:
                        np.add.at(depth, w, 1)
                        np.add.at(depth, w + LENGTH, -1)
                    gone = np.append(0, np.cumsum(depth)[:-1] > 0).astype(np.int8)
                    edges = np.flatnonzero(np.diff(np.append(gone, 0))).tolist()
                    spans = [{"start": a, "end": b} for a, b in zip(edges[0::2], edges[1::2])]
                    kept, last = [], 0
                    for s in spans:
                        kept += words[last:s["start"]]
                        last = s["end"]
                    kept += words[last:]
                else:
                    kept = words
                rows.append((len(words), spans, b" ".join(kept).decode("utf-8", "surrogatepass")))
            n, spans, kept = zip(*rows)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                names=["id", "doc_id", "n_words", "removed", "kept"])


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of ``docs``: ``doc_id``, ``n_words``, the ``removed`` maximal runs of words and the ``kept`` text."""
    small_batches(docs.sparkSession)
    own = F.col(doc_id).cast("bigint")
    rows = docs.select(F.coalesce(own, F.lit(-(1 << 63))).alias("id"), own.alias("doc_id"), text_or_empty(text).alias("text"))
    alone = rows.groupBy("id").count().where("count > 1").isEmpty()
    # rows of equal id are told apart by their text's hash
    rows = rows.withColumn("body", F.lit(0).cast("bigint") if alone else F.xxhash64("text"))
    seeds = rows.select("id", "body", "text").mapInArrow(anchor_rows, ANCHORS)
    anchor, around = Window.partitionBy("seed"), Window.partitionBy("seed", "full")
    judged = seeds.repartition("seed").withColumn("first", F.min("id").over(around)).select(
        "*", F.min("full").over(anchor).alias("low"), F.max("full").over(anchor).alias("high"), F.min("id").over(anchor).alias("least"),
        F.max("id").over(anchor).alias("most"), F.min(F.struct("id", "body", "place")).over(anchor).alias("lead"))
    repeat = F.col("known") | (F.col("first") < F.col("id"))
    met = stage(judged.where("known OR least < most").withColumn("repeat", repeat).where("repeat OR low < high").select(
        F.when(~F.col("repeat"), F.col("seed")).alias("seed"), "id", "body", "place", "repeat",
        (~F.col("repeat") & (F.col("lead") == F.struct("id", "body", "place"))).alias("leads")), "met")
    wanted = met.where("NOT repeat").groupBy("id", "body").agg(F.collect_list(F.struct("seed", "place", "leads")).alias("wanted"))
    live = stage(rows.join(wanted, ["id", "body"]).select("id", "body", "text", "wanted")
                 .mapInArrow(surroundings, LIVE + ", leads boolean"), "surroundings")
    whole = met.where("repeat").select(
        "id", "body", F.expr("shiftright(place, 8) * 512 + shiftleft(1L, cast(place & 15 as int)) - 1").alias("spot"))
    spots = whole.unionAll(resolve(live).select("id", "body", (F.col("start") * 512 + F.col("todo")).alias("spot")))
    cuts = spots.groupBy("id", "body").agg(F.collect_list("spot").alias("spots"))
    return rows.join(cuts, ["id", "body"], "left").select("id", "doc_id", "text", "spots").mapInArrow(cut_out, RESULT).drop("id")
