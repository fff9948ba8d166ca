from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from archivesearch.llm.exact_dedup import exact_dedup, keep_first, observe
from archivesearch.llm.common import shared_dir


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    return sorted((i, min(groups[t]), len(groups[t])) for (i, _), t in zip(rows, norm))


ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (1, None), (2, ""), (4, "x" * 300_000), (7, "x" * 300_000),
        (8, "é b"), (6, "c"), (10, "é b")]


def result(df):
    return sorted((r.id, r.keep_id, r.group_size) for r in df.collect())


def test_matches_brute_force(table):
    out = exact_dedup(table(ROWS))
    assert result(out) == brute(ROWS)
    assert {r.digest for r in out.collect() if r.id == 6} == {hashlib.sha256(b"c").hexdigest()}


def test_texts_under_one_digest_are_told_apart(table):
    out = exact_dedup(table(ROWS), digest=lambda text: F.lit("same"))
    assert result(out) == brute(ROWS)


def test_frames_without_files_empty_tables_and_other_columns(spark, table):
    made = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("id", F.lit(1)).withColumn("body", F.lit(""))
    assert result(exact_dedup(made)) == brute(ROWS)
    assert exact_dedup(table([])).count() == 0


def test_repeated_rows_and_null_ids(table):
    docs = table([(1, "a"), (1, "a"), (None, "a"), (None, "b")])
    out = exact_dedup(docs).collect()
    assert sum(r.locator == r.keep_locator for r in out) == 2
    assert {r.keep_id for r in out if r.group_size == 3} == {1}
    assert sorted((r.doc_id, r.text) for r in keep_first(docs).collect() if r.doc_id) == [(1, "a")]


def test_state_outlives_a_run(spark, table, tmp_path):
    state = shared_dir(spark, "test-state")
    log = str(tmp_path / "log")
    schema = "id bigint, locator string, digest string"
    for rows in ([(4, "f#1", "d"), (5, "f#2", "e")], [(2, "f#3", "d")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(log)
        held = observe(spark, spark.readStream.schema(schema).parquet(log), state)
    assert sorted((r.digest, r.first.id, r.n) for r in held.collect()) == [("d", 2, 2), ("e", 5, 1)]


def test_a_second_run_over_the_same_state(spark, table):
    """Copies across runs, and texts of earlier runs under one forced digest, are told apart by their bytes."""
    first, second = [(5, "a b"), (6, "c"), (8, "only one")], [(7, "a\n b"), (2, "c"), (9, "new"), (None, "c"), (4, "d")]
    for digest, state in ((None, shared_dir(spark, "runs")), (lambda text: F.lit("same"), shared_dir(spark, "clash"))):
        options = {"state_dir": state} | ({"digest": digest} if digest else {})
        assert result(exact_dedup(table(first), **options)) == brute(first)
        got = {r.id: (r.keep_id, r.group_size) for r in exact_dedup(table(second), **options).collect()}
        assert got == {7: (5, 2), 2: (2, 3), 9: (9, 1), None: (2, 3), 4: (4, 1)}
        assert result(exact_dedup(table([]), **options)) == []
        third = {r.id: (r.keep_id, r.group_size) for r in exact_dedup(table([(1, "only  one")]), **options).collect()}
        assert third == {1: (1, 2)}
