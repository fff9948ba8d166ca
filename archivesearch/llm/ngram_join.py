"""N-gram Jaccard join with token-combination prefixes.

A document's set is its distinct ``k``-word shingles (as 64-bit hashes; the whole
sequence of a shorter text). Two documents link when
``100 * shared >= percent * united``.

1. *Profile.* Each distinct set gets a 64-bit name, so copies are one set. Over
   all documents a counter table of fixed width (``2**SKETCH_BITS``) counts shingles
   by hash: the order of the prefixes, rarest first, and so the same for all.
2. *Prefixes.* Linked sets of ``n`` shingles share ``k`` of their first
   ``n - ceil(percent/100 * n) + k`` ones. Here ``k = g + 2`` for sets of a size class
   with ``g`` token groups (classes double, and sets just below a class also join it).
3. *Classes of tokens.* A token whose bucket of prefixes has at most ``RARE`` rows is
   rare and indexed alone; pairs in its bucket must meet in two rare tokens.
   Otherwise it is frequent and only combinations of two frequent tokens of one
   token group are indexed. Of ``g + 2`` shared tokens either two are rare, or
   ``g + 1`` are frequent and so two of them lie in one of the ``g`` groups: no link
   is lost. Tokens that the counters already show as very common go to the
   combinations directly and never form a bucket of their own.
4. *Verify.* Pairs of rare buckets, and in combination buckets each member with the
   smallest one, are compared on their whole sets; then each member with one drawn member
   of another component. Members of a bucket that are then still in different components
   are compared all with all, block by block within tasks that return links only. A bucket
   of n copies with small changes costs about n comparisons, and no pair is left out.
5. *Components* by alternating stars over the verified links.

Defined cases: texts without words (null too) have an empty set and link with
nothing; equal ids are separate rows with one component per set; a component's
id is the smallest document id in it (null ids only if all are null); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import lean, settings, stage, text_or_empty
from archivesearch.llm.components import as_links, components
from archivesearch.llm.hashing import ODD, U, mix, shingle_sets

SKETCH_BITS = 21
SKETCH_PARTS = 64
RARE = 8
FIRST_CLASS = 64  # sets below are class 0
BLOCK = 128
SALTS = 64


def set_name(tokens: np.ndarray) -> int:
    """A 64-bit sum over a set; signed."""
    x = int(mix(tokens).sum(dtype=U))
    return x - (1 << 64) if x >> 63 else x


def size_classes(n: int, percent: int) -> list[int]:
    """The classes that a set of ``n`` tokens joins: its own, and the next one if a link can reach it."""
    own = 0 if n < FIRST_CLASS else (n // FIRST_CLASS).bit_length()
    above = FIRST_CLASS << own
    return [own, own + 1] if 100 * n >= percent * above else [own]


def prefix_length(n: int, cls: int, percent: int) -> int:
    least = -(-percent * n // 100)
    return min(n, n - least + token_groups(cls) + 2)


def token_groups(cls: int) -> int:
    return 1 << cls


def least_linkable(percent: int) -> int:
    """Smaller sets link with equal sets only: a difference of one in ``n`` is already too much."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


# --- profile ---------------------------------------------------------------

PROFILE = "id bigint, tag bigint, n int, name bigint, part int, salt int, counts binary"


def profile(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents, then this task's counters in parts."""
    schema = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("n", pa.int32()), ("name", pa.int64()),
                        ("part", pa.int32()), ("salt", pa.int32()), ("counts", pa.binary())])
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for batch in lean(batches):
        sizes, names = [], []
        for tokens in shingle_sets(batch.column(2).to_pylist(), k):
            at = (tokens >> U(64 - SKETCH_BITS)).astype(np.int64)
            counts[at] += counts[at] < 255  # a task's counter that is full stays full
            sizes.append(len(tokens))
            names.append(set_name(tokens))
        none = [None] * len(sizes)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             *(pa.array(c, t) for c, t in zip((sizes, names, none, none, none), schema.types[2:]))],
            schema=schema)
    if counts.any():
        salt = TaskContext.get().partitionId() % SALTS
        for part, own in enumerate(np.split(counts, SKETCH_PARTS)):
            row = (None, None, None, None, part, salt, own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)


def _add(dtype: type) -> object:
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, dtype=np.uint64)
        for c in pdf["counts"]:
            total += np.frombuffer(c, dtype=dtype)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "salt": pdf["salt"].iloc[:1],
                             "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})

    return add


def counter_table(rows: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters: ``4 << SKETCH_BITS`` bytes, whatever the input."""
    schema = "part int, salt int, counts binary"
    some = rows.select("part", "salt", "counts").groupBy("part", "salt").applyInPandas(_add(np.uint8), schema)
    parts = some.groupBy("part").applyInPandas(_add(np.uint32), schema).collect()
    table = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    width = len(table) // SKETCH_PARTS
    for r in parts:
        table[r.part * width:(r.part + 1) * width] = np.frombuffer(r.counts, np.uint32)
    return table


# --- prefixes and buckets ----------------------------------------------------

POSTINGS = "route bigint, name bigint, n int, cls int, token bigint, common boolean"


def postings(batches: Iterator[pa.RecordBatch], k: int, percent: int, table: np.ndarray, common_at: int,
             ) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("route", pa.int64()), ("name", pa.int64()), ("n", pa.int32()), ("cls", pa.int32()),
                        ("token", pa.int64()), ("common", pa.bool_())])
    least, met = least_linkable(percent), set()
    for batch in lean(batches):
        routes, names, sizes, classes, tokens_out, commons = [], [], [], [], [], []
        for tokens in shingle_sets(batch.column(0).to_pylist(), k):
            n = len(tokens)
            if n < least:
                continue
            name = set_name(tokens)
            if name in met:  # a copy within this task
                continue
            met.add(name)
            seen = table[(tokens >> U(64 - SKETCH_BITS)).astype(np.int64)]
            order = np.argsort((seen.astype(U) << U(32)) | (tokens & U(0xFFFFFFFF)), kind="stable")
            for cls in size_classes(n, percent):
                take = order[:prefix_length(n, cls, percent)]
                own = tokens[take]
                common = seen[take] > common_at
                key = mix(own + U(cls + 1) * ODD).view(np.int64)
                routes.append(np.where(common, name, key))
                tokens_out.append(np.where(common, key, 0))  # else the route says it
                commons.append(common)
                names.append(np.full(len(own), name))
                sizes.append(np.full(len(own), n, np.int32))
                classes.append(np.full(len(own), cls, np.int32))
        cols = (routes, names, sizes, classes, tokens_out, commons)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c) if c else np.empty(0), t) for c, t in zip(cols, schema.types)], schema=schema)


MEMBERS = "a bigint, b bigint, cls int, token bigint"


def buckets(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket in, pairs ``(a, b)`` of rare buckets and ``(a, cls, token)`` of frequent tokens out.

    A bucket that outgrows ``RARE`` is passed on as it streams by, so no bucket is held."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cls", pa.int32()), ("token", pa.int64())])

    def out(a, b, cls, token) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), *(pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in
             ((b, pa.int64()), (cls, pa.int32()), (token, pa.int64())))], schema=schema)

    def settle(rows: dict[str, np.ndarray], large: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets; ``large`` marks rows of frequent or common tokens."""
        if large.any():
            token = np.where(rows["common"], rows["token"], rows["route"])
            yield out(rows["name"][large], None, rows["cls"][large], token[large])
        route, name, n = (rows[c][~large] for c in ("route", "name", "n"))
        for lag in range(1, RARE):
            same = (route[:-lag] == route[lag:]) & (name[:-lag] != name[lag:])
            small, big = np.minimum(n[:-lag], n[lag:]), np.maximum(n[:-lag], n[lag:])
            at = np.flatnonzero(same & (small.astype(np.int64) * 100 >= big.astype(np.int64) * percent))
            if len(at):
                x, y = name[:-lag][at], name[lag:][at]
                yield out(np.minimum(x, y), np.maximum(x, y), None, None)

    names = ["route", "name", "n", "cls", "token", "common"]
    kept: dict[str, np.ndarray] | None = None
    flowing = None  # the route of a bucket known to be frequent
    for batch in lean(batches):
        rows = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(names)}
        if kept is not None:
            rows = {c: np.concatenate([kept[c], rows[c]]) for c in names}
        if not len(rows["route"]):
            continue
        starts = np.flatnonzero(np.append(True, rows["route"][1:] != rows["route"][:-1]))
        lengths = np.diff(np.append(starts, len(rows["route"])))
        large = np.repeat((lengths > RARE) | (rows["route"][starts] == flowing), lengths) | rows["common"]
        last = starts[-1]
        if large[last]:
            flowing, last = rows["route"][last], len(large)
        yield from settle({c: v[:last] for c, v in rows.items()}, large[:last])
        kept = {c: v[last:] for c, v in rows.items()}
    if kept is not None and len(kept["route"]):
        yield from settle(kept, np.full(len(kept["route"]), len(kept["route"]) > RARE) | kept["common"])


# --- verification ------------------------------------------------------------

def named_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """``(name, tokens)`` of the texts whose set has the wanted name."""
    for batch in lean(batches):
        for at in range(0, max(1, batch.num_rows), 512):
            part = batch.slice(at, 512)
            found = [(want, t.tobytes()) for want, t in zip(part.column(0).to_pylist(),
                                                            shingle_sets(part.column(1).to_pylist(), k))
                     if set_name(t) == want]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.binary())], names=["name", "tokens"])


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < max(len(x), len(y)) * percent:
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in lean(batches):
        ok = []
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            ok += [linked(np.frombuffer(x, U), np.frombuffer(y, U), percent)
                   for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
        links = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
        yield links.filter(pa.array(ok, pa.bool_()))


def set_components(docs: DataFrame, sets: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """``(node, root)``: the component of each name of a set that links with another set.

    ``docs``: ``(id, body)``; ``sets``: ``(name, n, id)``, one document id of each set."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(counts)  # of fixed size
    common_at = int(4 * counts.mean()) + 1000
    dealt = docs.select("body").mapInArrow(
        lambda it: postings(it, k, percent, table.value, common_at), POSTINGS)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = stage(dealt.repartition(n, "route").sortWithinPartitions("route", "name").mapInArrow(
        lambda it: buckets(it, percent), MEMBERS), "members")
    rare = members.where("b IS NOT NULL").groupBy("a", "b").count().where("count > 1").select("a", "b")
    group = F.expr("pmod(xxhash64(token), shiftleft(1, cls))")
    per_set = members.where("b IS NULL").groupBy("a", "cls", group.alias("grp")).agg(
        F.array_sort(F.collect_set("token")).alias("t"))  # of one set's prefix
    combos = stage(per_set.where("size(t) > 1").select("a", "cls", "t", F.explode(F.expr("sequence(0, size(t) - 2)")).alias("i"))
                   .select("a", F.col("cls"), F.expr("t[i]").alias("x"), F.explode(F.expr("slice(t, i + 2, size(t))")).alias("y"))
                   .select(F.xxhash64("cls", "x", "y").alias("bucket"), F.col("a").alias("name")), "combinations")
    firsts = combos.groupBy("bucket").agg(F.min("name").alias("pivot"), F.max("name").alias("high")).where("pivot < high")
    # buckets of the same members (the tokens of one passage, say) are one bucket
    both = combos.join(firsts.select("bucket"), "bucket", "left_semi").distinct()
    members_of = both.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("name").alias("low"), F.max("name").alias("high"),
        F.bit_xor(F.xxhash64("name")).alias("x"), F.bit_xor(F.xxhash64("name", F.lit(1))).alias("y"))
    kept = members_of.groupBy("n", "low", "high", "x", "y").agg(F.min("bucket").alias("bucket"))
    shared = stage(both.join(kept.select("bucket", F.col("low").alias("pivot")), "bucket"), "shared-combinations")
    stars = shared.where("name != pivot").select(F.col("pivot").alias("a"), F.col("name").alias("b"))
    size_a = sets.select(F.col("name").alias("a"), F.col("n").alias("na"))
    size_b = sets.select(F.col("name").alias("b"), F.col("n").alias("nb"))

    def fitting(pairs: DataFrame, purpose: str) -> DataFrame:
        return stage(pairs.join(size_a, "a").join(size_b, "b").where(
            f"least(na, nb) * 100L >= greatest(na, nb) * {percent}L").select("a", "b").distinct(), f"pairs-{purpose}")

    tried = fitting(rare.unionAll(stars), "first")
    # the sets of all pairs, of these and of later ones
    wanted = tried.select(F.col("a").alias("name")).unionAll(tried.select("b")).unionAll(shared.select("name")).distinct()
    bodies = docs.join(wanted.join(sets, "name").select("name", F.col("id").alias("__id")),
                       F.col("id").eqNullSafe(F.col("__id"))).select("name", "body")
    tokens = stage(bodies.mapInArrow(lambda it: named_sets(it, k), "name bigint, tokens binary"), "tokens")
    x = tokens.select(F.col("name").alias("a"), F.col("tokens").alias("x"))
    y = tokens.select(F.col("name").alias("b"), F.col("tokens").alias("y"))

    def compare(pairs: DataFrame, purpose: str) -> DataFrame:
        """Those pairs that link."""
        return stage(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(
            lambda it: verified(it, percent), "a bigint, b bigint"), f"links-{purpose}")

    first = components(compare(tried, "first"))
    drawn = open_buckets(shared, first)  # each member with one of another component, drawn by hash
    other = drawn.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("name", F.lit(1)).alias("h"), "name", "root")).alias("p"))
    apart = drawn.join(other, "bucket").where("root != p.root").select(
        F.least("name", "p.name").alias("a"), F.greatest("name", "p.name").alias("b")).distinct()
    more = compare(fitting(apart.join(tried, ["a", "b"], "left_anti"), "drawn"), "drawn")
    second = components(as_links(first).unionAll(more))
    return components(as_links(second).unionAll(rest_links(open_buckets(shared, second), tokens, percent)))


def open_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``(bucket, name, root)`` of the buckets whose members lie in several components."""
    marked = shared.select("bucket", "name").join(roots.withColumnRenamed("node", "name"), "name", "left").select(
        "bucket", "name", F.coalesce("root", "name").alias("root"))
    mixed = marked.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return stage(marked.join(mixed.select("bucket"), "bucket", "left_semi"), "open")


def rest_links(open_rows: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that are still in different components.

    The sets that buckets connect are cut into blocks of ``BLOCK`` and every two blocks
    meet in one task, which compares the pairs that share a bucket and returns links only."""
    pivots = open_rows.groupBy("bucket").agg(F.min("name").alias("b"))
    family = components(open_rows.join(pivots, "bucket").select(F.col("name").alias("a"), "b").distinct())
    sized = family.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = family.join(sized, "root").select(
        F.col("node").alias("name"), F.col("root").alias("family"), "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    rows = open_rows.groupBy("name").agg(F.first("root").alias("root"), F.collect_set("bucket").alias("buckets")).join(
        placed, "name").join(tokens.dropDuplicates(["name"]), "name")
    met = rows.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "family", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "name", "root",
        "buckets", "tokens")
    return stage(met.groupBy("family", "i", "j").applyInArrow(block_links(percent), "a bigint, b bigint"), "links-rest")


def block_links(percent: int):
    def compare(rows: pa.Table) -> pa.Table:
        names, roots, blocks = (rows.column(c).to_numpy() for c in ("name", "root", "block"))
        one_block = rows.column("i")[0] == rows.column("j")[0]
        lists = rows.column("buckets").to_pylist()
        bucket = np.concatenate([np.array(x, dtype=np.int64) for x in lists])
        owner = np.repeat(np.arange(len(names)), [len(x) for x in lists])
        order = np.argsort(bucket, kind="stable")
        bucket, owner = bucket[order], owner[order]
        near = np.zeros((len(names), len(names)), dtype=bool)  # of two blocks at most
        for own in np.split(owner, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1):
            near[np.ix_(own, own)] = True
        near &= roots[:, None] != roots[None, :]
        near &= names[:, None] < names[None, :]
        if not one_block:
            near &= blocks[:, None] != blocks[None, :]
        sets = [np.frombuffer(t, U) for t in rows.column("tokens").to_pylist()]
        links = [(int(names[x]), int(names[y])) for x, y in zip(*np.nonzero(near)) if linked(sets[x], sets[y], percent)]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return compare


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text",
                       ) -> DataFrame:
    """``(id, tag, n_shingles, name, root, component_id)`` for each row of ``docs``; ``tag`` is a hash of the
    text, ``name`` of the set, and ``root`` names the component (null without words)."""
    body = text_or_empty(text)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(body).alias("tag"), body.alias("body"))
    seen = stage(rows.mapInArrow(lambda it: profile(it, k), PROFILE), "profile")
    counts = counter_table(seen.where("part IS NOT NULL"))
    each = seen.where("part IS NULL").select("id", "tag", "n", "name")
    sets = stage(each.where("n > 0").groupBy("name").agg(F.max("n").alias("n"), F.min("id").alias("id")), "sets")
    # tables of links and buckets are joined on the executors; the driver would hold some fifty of them at once
    with settings(docs.sparkSession, spark__sql__autoBroadcastJoinThreshold="-1"):
        roots = set_components(rows.select("id", "body"), sets, counts, k, percent)
    named = sets.join(roots.withColumnRenamed("node", "name"), "name", "left").select(
        "name", "id", F.coalesce("root", "name").alias("root"))
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_set = named.join(smallest, "root").select("name", "root", "component_id")
    alone = each.where("n = 0").select("id", "tag", F.lit(0).cast("bigint").alias("n_shingles"),
                                       F.lit(None).cast("bigint").alias("name"), F.lit(None).cast("bigint").alias("root"),
                                       F.col("id").alias("component_id"))
    return each.where("n > 0").join(of_set, "name").select(
        "id", "tag", F.col("n").cast("bigint").alias("n_shingles"), "name", "root", "component_id").unionAll(alone)


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, less the rows whose component has a row that comes first by (id, text hash).

    Rows without words are kept; so are repeats of the row that stays."""
    found = jaccard_components(docs, k, percent, doc_id, text).where("n_shingles > 0")
    stays = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("first"))
    gone = found.join(stays, "root").where(
        "NOT (id <=> first.id AND tag = first.tag)").select(F.col("id").alias("__id"), F.col("tag").alias("__tag")).distinct()
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text)) == F.col("__tag"))
    return docs.join(stage(gone, "near-copies"), same, "left_anti")
