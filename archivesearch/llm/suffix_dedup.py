"""Removal of repeated byte strings by prefix-free parsing.

A byte goes if a string of ``LENGTH`` (100) bytes that covers it also starts
earlier: in a document of a smaller id, or earlier in the same document.

1. *Parse.* A rolling hash of ``GRAM`` bytes triggers phrase borders: in every run of
   ``LENGTH - GRAM + 1`` grams the smallest hash is the trigger. The strings that share a
   trigger form one phrase: the bytes that they cover. A string's trigger depends on its own
   bytes alone, so equal strings lie at the same place of phrases with the same trigger.
2. *Phrases.* They are dealt out by trigger and grouped by (trigger hash, content hash). All but
   the first of a group by (document, place) are repeated as a whole. A phrase whose trigger is
   unique holds no repeated string and ends here.
3. *Windows.* First phrases whose trigger also heads other contents may share some of their
   strings. Only their ``LENGTH``-byte windows are grouped, by a 64-bit hash; all but the first of
   a group by (document, place) are repeated.
4. Each document's repeated strings are merged and cut out.

This stands in place of suffix arrays of dictionary and parse, which are neither built nor merged:
only equality to depth ``LENGTH`` and the first place of a string decide, not the order of
suffixes. Hashes of the bytes are made by prefix doubling, and compared instead of the bytes.
Each task first merges what it has itself, and a trigger that heads very many
contents in one task goes to step 3 at once, so a common passage adds few rows per task.

Defined cases: a null text is empty; matches never cross documents; rows of equal id and text
are one document; rows of equal id and other texts are ordered by a hash of the text; a null
id comes last; texts shorter than ``LENGTH`` keep all bytes; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import stage, text_or_empty
from archivesearch.llm.hashing import ODD, U, mix

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
PIECE = 1 << 19  # bytes hashed at once; positions take 20 bits
FLUSH = 1 << 21
MANY = 64
LAST = (1 << 63) - 1

_BYTES = mix(np.arange(1, 257, dtype=U) * ODD)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * U(0xC2B2AE3D27D4EB4F)
    x ^= b * U(0x165667B19E3779F9) + (a >> U(29))
    x *= ODD
    x ^= x >> U(32)
    return x


def doubled(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``GRAM`` and ``LENGTH`` bytes from each place where they fit."""
    h, n, gram = _BYTES[raw], 1, None
    while 2 * n <= LENGTH:
        h = _pair(h[:-n], h[n:])
        n *= 2
        if n == GRAM:
            gram = h
    return gram, _pair(h[:len(raw) - LENGTH + 1], h[LENGTH - n:])


def pieces(bodies: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers of at most ``PIECE`` bytes with ``(document, place in it, from, to)`` of each part.

    Parts of one document overlap by ``LENGTH - 1`` bytes, so each string lies in one part."""
    buffer, parts, size = [], [], 0
    for d, body in enumerate(bodies):
        for at in range(0, len(body) - LENGTH + 1, PIECE - LENGTH + 1):
            part = body[at:at + PIECE]
            if size + len(part) > PIECE:
                yield np.frombuffer(b"".join(buffer), np.uint8), parts
                buffer, parts, size = [], [], 0
            parts.append((d, at, size, size + len(part)))
            buffer.append(part)
            size += len(part)
    if parts:
        yield np.frombuffer(b"".join(buffer), np.uint8), parts


def parse(bodies: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """``(trigger, content, document, first string, further strings)`` of the phrases."""
    for raw, parts in pieces(bodies):
        gram, string = doubled(raw)
        key = (gram & ~U(0xFFFFF)) | np.arange(len(gram), dtype=U)
        low, n = key, 1
        while 2 * n <= SPAN:
            low = np.minimum(low[:-n], low[n:])
            n *= 2
        low = np.minimum(low[:len(key) - SPAN + 1], low[SPAN - n:len(key) - n + 1])
        starts = np.concatenate([np.arange(a, b - LENGTH + 1) for _, _, a, b in parts])
        owner = np.repeat(np.arange(len(parts)), [b - a - LENGTH + 1 for _, _, a, b in parts])
        trigger = (low[starts] & U(0xFFFFF)).astype(np.int64)
        turn = np.flatnonzero((trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1])) + 1
        first = np.append(0, turn)
        last = np.append(turn, len(starts)) - 1
        left, right, at = starts[first], starts[last], trigger[first]
        content = mix(_pair(string[left], string[right]) + (right - left).astype(U) * ODD + (at - left).astype(U))
        document = np.array([p[0] for p in parts])[owner[first]]
        place = left - np.array([p[2] - p[1] for p in parts])[owner[first]]
        # two triggers of equal first 48 bits share a group, which costs checks and changes nothing
        yield gram[at] >> U(16), content, document, place, right - left


def strings(bodies: list[bytes], document: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``(hash, document, place)`` of the wanted strings, given in order of document and place."""
    for raw, parts in pieces(bodies):
        _, string = doubled(raw)
        for d, at, a, b in parts:
            lo = np.searchsorted(document, d) if len(document) else 0
            hi = np.searchsorted(document, d, "right") if len(document) else 0
            own = place[lo:hi]
            own = own[(own >= at) & (own <= at + b - a - LENGTH)]
            if len(own):
                yield string[own - at + a], np.full(len(own), d), own


def first_of(key: np.ndarray, ids: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Mask of the rows that come first by (id, rest) among rows of equal key."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    repeated = np.append(False, k[1:] == k[:-1])
    several = np.flatnonzero(repeated | np.append(repeated[1:], False))
    mask = np.ones(len(key), bool)
    if len(several):
        rows = order[several]
        rows = rows[np.lexsort((rest[rows], ids[rows], key[rows]))]
        mask[rows] = at_first(key[rows], ids[rows], rest[rows])
    return mask


def at_first(key: np.ndarray, ids: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Of rows sorted by key, id and rest: which have the same id and rest as the first of their key."""
    head = np.append(True, key[1:] != key[:-1])
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    return (ids == ids[first]) & (rest == rest[first])


ROWS = "k1 bigint, k2 bigint, id bigint, tag int, place int, more int, kind int"
SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("tag", pa.int32()),
                    ("place", pa.int32()), ("more", pa.int32()), ("kind", pa.int32())])
# kinds of rows; suffixes of phrases to check meet by trigger, or one by one where a trigger is crowded
FIRST, REPEATED, MARK, CHECK, CHECK_EACH = range(5)


def _rows(k1, k2, ids, tag, place, more, kind) -> pa.RecordBatch:
    cols = (k1.view(np.int64), k2.view(np.int64), ids, tag, place, more, kind)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, SCHEMA.types)], schema=SCHEMA)


def phrase_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of ``(id, tag, body)``, those equal within the task merged."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        trigger, content, ids, tag, place, more = (np.concatenate(c) for c in zip(*held))
        held.clear()
        rest = tag.astype(np.int64) << 32 | place
        both = mix(trigger + content * ODD)
        kind = np.where(first_of(both, ids, rest), FIRST, REPEATED).astype(np.int32)
        alone = np.flatnonzero(kind == FIRST)
        heads, at, n = np.unique(trigger[alone], return_inverse=True, return_counts=True)
        kind[alone[(n > MANY)[at]]] = CHECK_EACH
        spread = mix(rest.view(U) + ids.view(U) * ODD)  # rows that need not meet others
        k1 = np.where(kind == FIRST, trigger, spread)
        yield _rows(k1, content, ids, tag, place, more, kind)
        crowded = heads[n > MANY]
        zero = np.zeros(len(crowded), np.int64)
        yield _rows(crowded, zero.view(U), zero, zero, zero, zero, np.full(len(crowded), MARK))

    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids, tags = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            bodies = [t.encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
            for trigger, content, document, place, more in parse(bodies):
                held.append((trigger, content, ids[document], tags[document], place, more))
                count += len(trigger)
            if count > FLUSH:
                yield from flush()
                count = 0
    if held:
        yield from flush()


def settle_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k1, k2, id, tag, place) in; repeated phrases, and those to check, out."""
    names = [*SCHEMA.names]

    def settle(r: dict[str, np.ndarray]) -> pa.RecordBatch:
        plain = r["kind"] == FIRST
        k1, k2 = r["k1"], r["k2"]
        head = np.append(True, k1[1:] != k1[:-1])
        run = np.cumsum(head) - 1
        fresh = plain.copy()  # first of its content
        rows = np.flatnonzero(plain)
        rest = r["tag"].astype(np.int64) << 32 | r["place"]
        if len(rows):
            content = np.cumsum(np.append(True, (k1[rows][1:] != k1[rows][:-1]) | (k2[rows][1:] != k2[rows][:-1])))
            fresh[rows] = at_first(content, r["id"][rows], rest[rows])
        contents, crowded = np.bincount(run, weights=fresh), np.bincount(run, weights=r["kind"] == MARK) > 0
        kind = np.full(len(k1), -1, np.int32)
        kind[plain & ~fresh] = REPEATED
        kind[fresh & (contents[run] > 1)] = CHECK
        kind[fresh & crowded[run]] = CHECK_EACH
        kind = np.where((r["kind"] == REPEATED) | (r["kind"] == CHECK_EACH), r["kind"], kind)
        out = kind >= 0
        return _rows(*(r[c][out] for c in names[:-1]), kind[out])

    yield from _by_run(batches, names, settle)


STRINGS = "k1 bigint, id bigint, tag int, place int, more int, kind int, body binary"
_STRINGS = pa.schema([("k1", pa.int64()), ("id", pa.int64()), ("tag", pa.int32()), ("place", pa.int32()),
                      ("more", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])


def joined_runs(ids: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heads of runs of consecutive places in one document, and how many places follow each."""
    head = np.append(True, (rest[1:] != rest[:-1] + 1) | (ids[1:] != ids[:-1]))
    at = np.flatnonzero(head)
    return at, np.diff(np.append(at, len(ids))) - 1


def settle_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k1, id, tag, place) in; repeated strings out, as ``(id, tag, place, more)``."""
    names = [*_STRINGS.names]

    def settle(r: dict[str, np.ndarray]) -> pa.RecordBatch:
        rest = r["tag"].astype(np.int64) << 32 | r["place"]
        found = [(r["id"], rest, r["more"], np.flatnonzero(r["kind"] == REPEATED))]
        each = np.flatnonzero(r["kind"] == FIRST)
        if len(each):
            late = each[~at_first(r["k1"][each], r["id"][each], rest[each])]
            found.append((r["id"], rest, np.zeros(len(rest), np.int64), late))
        rows = np.flatnonzero(r["kind"] == CHECK)  # phrases: order the suffixes of their bytes
        if len(rows):
            more = r["more"][rows].astype(np.int64)
            raw = np.frombuffer(b"".join(r["body"][rows]), np.uint8)
            start = np.cumsum(more + LENGTH) - (more + LENGTH)
            step = np.arange((more + 1).sum()) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)
            of = np.repeat(np.arange(len(rows)), more + 1)
            string = doubled(raw)[1][start[of] + step]
            ids, places = r["id"][rows][of], rest[rows][of] + step
            late = np.flatnonzero(~first_of(string, ids, places))
            if len(late):
                at, follow = joined_runs(ids[late], places[late])
                found.append((ids[late][at], places[late][at], follow, np.arange(len(at))))
        ids, rest, more = (np.concatenate([f[k][f[3]] for f in found]) for k in range(3))
        cols = (ids, rest >> 32, rest & 0xFFFFFFFF, more)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _FOUND.types)], schema=_FOUND)

    yield from _by_run(batches, names, settle)


FOUND = "id bigint, tag int, place int, more int"
_FOUND = pa.schema([("id", pa.int64()), ("tag", pa.int32()), ("place", pa.int32()), ("more", pa.int32())])


def _by_run(batches, names, settle) -> Iterator[pa.RecordBatch]:
    """Apply ``settle`` to whole runs of equal ``k1`` (a few rows of each task at most)."""
    kept = None
    for batch in batches:
        r = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(names)}
        if kept is not None:
            r = {c: np.concatenate([kept[c], r[c]]) for c in names}
        if not len(r["k1"]):
            continue
        last = int(np.searchsorted(r["k1"], r["k1"][-1]))
        if last:
            yield settle({c: v[:last] for c, v in r.items()})
        kept = {c: v[last:] for c, v in r.items()}
    if kept is not None and len(kept["k1"]):
        yield settle(kept)


def string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ``(id, tag, body, check, each)``: the bytes of the phrases to check by their trigger, and the
    single strings of crowded triggers, those equal within the task merged."""
    held: list[tuple[np.ndarray, ...]] = []

    def rows(*cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _STRINGS.types)], schema=_STRINGS)

    def flush() -> Iterator[pa.RecordBatch]:
        h, ids, rest = (np.concatenate(c) for c in zip(*held))
        held.clear()
        fresh = first_of(h, ids, rest)
        for kind, own in ((FIRST, np.flatnonzero(fresh)), (REPEATED, np.flatnonzero(~fresh))):
            more = np.zeros(len(own), np.int64)
            if kind == REPEATED and len(own):  # rows come by document and place: runs are one row
                at, more = joined_runs(ids[own], rest[own])
                own = own[at]
            k1 = h[own] if kind == FIRST else mix(rest[own].view(U) + ids[own].view(U) * ODD)
            yield rows(k1.view(np.int64), ids[own], rest[own] >> 32, rest[own] & 0xFFFFFFFF, more, np.full(len(own), kind),
                       [None] * len(own))

    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids, tags = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            bodies = [t.encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
            out: list[tuple] = []
            document, place = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for d, (body, check, each) in enumerate(zip(bodies, part.column(3).to_pylist(), part.column(4).to_pylist())):
                out += [(f["k1"], ids[d], tags[d], f["place"], f["more"], CHECK, body[f["place"]:f["place"] + f["more"] + LENGTH])
                        for f in check]
                if each:
                    own = np.unique(np.concatenate([np.arange(f["place"], f["place"] + f["more"] + 1) for f in each]))
                    document.append(np.full(len(own), d))
                    place.append(own)
            if out:
                yield rows(*zip(*out))
            for h, d, p in strings(bodies, np.concatenate(document), np.concatenate(place)):
                held.append((h, ids[d], tags[d].astype(np.int64) << 32 | p))
                count += len(h)
            if count > FLUSH:
                yield from flush()
                count = 0
    if held:
        yield from flush()


def removed_spans(places: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs ``[start, end)`` of the strings that start at ``place .. place + more``."""
    order = np.argsort(places, kind="stable")
    start, end = places[order], (places + more + LENGTH)[order]
    reach = np.maximum.accumulate(end)
    head = np.append(True, start[1:] > reach[:-1])
    return start[head], np.append(reach[:-1][head[1:]], reach[-1])


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, body, found)`` to counts, spans and the digest of the bytes that stay."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for body, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = body.encode("utf-8", "surrogatepass")
            start, end = (x.tolist() for x in removed_spans(np.array([f["place"] for f in found], np.int64),
                                                             np.array([f["more"] for f in found], np.int64)))
            digest, at = hashlib.sha256(), 0
            for s, e in zip(start, end):
                digest.update(raw[at:s])
                at = e
            digest.update(raw[at:])
            out.append((len(raw), sum(end) - sum(start), digest.hexdigest(), [{"start": s, "end": e} for s, e in zip(start, end)]))
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), spans)))],
            names=["id", "n_bytes", "n_removed", "kept_sha256", "removed"])


RESULT = "id bigint, n_bytes bigint, n_removed bigint, kept_sha256 string, removed array<struct<start:bigint,end:bigint>>"


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:data:`RESULT` for each row of ``docs``."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = text_or_empty(text)
    ids = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST))).alias("ids")).first()
    # only where ids repeat does a hash of the text tell their rows apart
    tag = F.xxhash64(body).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int") if ids.n != ids.ids else F.lit(0)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("id"), tag.alias("tag"), body.alias("body"))

    phrases = rows.mapInArrow(phrase_rows, ROWS).repartition(n, "k1").sortWithinPartitions("k1", "k2", "id", "tag", "place")
    found = stage(phrases.mapInArrow(settle_phrases, ROWS).select(
        "id", "tag", "place", "more", "kind", F.when(F.col("kind") == CHECK, F.col("k1")).alias("k1")), "phrases")
    of_doc = found.groupBy("id", "tag").agg(
        F.collect_list(F.when(F.col("kind") == REPEATED, F.struct("place", "more"))).alias("repeated"),
        F.collect_list(F.when(F.col("kind") == CHECK, F.struct("place", "more", "k1"))).alias("check"),
        F.collect_list(F.when(F.col("kind") == CHECK_EACH, F.struct("place", "more"))).alias("each"))
    concerned = stage(rows.join(of_doc, ["id", "tag"]).select("id", "tag", "body", "check", "each", "repeated"), "concerned")

    suffixes = concerned.where("size(check) + size(each) > 0").select("id", "tag", "body", "check", "each").mapInArrow(
        string_rows, STRINGS)
    again = suffixes.repartition(n, "k1").sortWithinPartitions("k1", "id", "tag", "place").mapInArrow(settle_strings, FOUND)
    own = stage(again.groupBy("id", "tag").agg(F.collect_list(F.struct("place", "more")).alias("own")), "own")
    merged = concerned.join(own, ["id", "tag"], "left").select(
        "id", "tag", "body", F.expr("concat(repeated, coalesce(own, cast(array() as array<struct<place:int,more:int>>)))").alias("all"))
    back = F.nullif(F.col("id"), F.lit(LAST)).alias("id")
    cut_rows = merged.where("size(all) > 0").select(back, "body", "all").mapInArrow(cut, RESULT)
    touched = found.where(F.col("kind") == REPEATED).select("id", "tag").unionAll(own.select("id", "tag")).distinct()
    whole = rows.select("id", "tag", F.octet_length("body").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
                        F.sha2(F.col("body").cast("binary"), 256).alias("kept_sha256")).join(
        touched, ["id", "tag"], "left_anti").select(
        back, "n_bytes", "n_removed", "kept_sha256", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("removed"))
    return cut_rows.unionAll(whole)
