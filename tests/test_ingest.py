"""Ingest of odd inputs: several records in a member, other encodings, broken archives, repeated ids."""

from __future__ import annotations

import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from archivesearch.config import EmbeddingParams
from archivesearch.functions import text as tx
from archivesearch.operators import embeddings as emb
from archivesearch.operators import results as res
from archivesearch.operators import sampling, vector
from archivesearch.sources import archives as arc
from archivesearch.sources import sinks
from archivesearch.sources import xml as xmlsrc
from archivesearch.streaming import ingest
from archivesearch.config import IngestParams


def record(doc_id, text="t"):
    return f"<Record><RecordID>{doc_id}</RecordID><RecordTitle>T</RecordTitle><FullText>{text}</FullText></Record>"


def write_zip(folder, name, members):
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(os.path.join(folder, name), "w") as zf:
        for member, body in members.items():
            zf.writestr(member, body)


def test_every_record_of_a_member(spark):
    rows = [("two", record(1, "a") + "\n" + record(2, "b")),
            ("wrapped", f"<?xml version='1.0'?><Records>{record(3)}{record(4)}{record(5)}</Records>"),
            ("cut", record(6) + "<Record><RecordID>7"), ("none", "<Other/>")]
    good, bad = xmlsrc.split_rejects(xmlsrc.parse_records(spark.createDataFrame(rows, "member string, xml string")))
    assert sorted((r.member, r.record_no, r.doc_id) for r in good.collect()) == [
        ("cut", 0, 6), ("two", 0, 1), ("two", 1, 2), ("wrapped", 0, 3), ("wrapped", 1, 4), ("wrapped", 2, 5)]
    assert sorted((r.member, r.reason) for r in bad.collect()) == [("cut", "malformed"), ("none", "missing RecordID")]


def test_files_give_the_columns_of_members(spark, tmp_path):
    (tmp_path / "a.xml").write_text(record(1, "x y") + record(2))
    rows = xmlsrc.read_xml_files(spark, str(tmp_path)).collect()
    assert sorted((r.member, r.doc_id, r.full_text) for r in rows) == [("a.xml", 1, "x y"), ("a.xml", 2, "t")]


def test_encodings_and_broken_archives_are_isolated(spark, tmp_path):
    latin = '<?xml version="1.0" encoding="ISO-8859-1"?>' + record(1, "café señor")
    write_zip(tmp_path, "a.zip", {"latin.xml": latin.encode("latin-1"), "utf16.xml": record(2, "é").encode("utf-16"),
                                  "bad.xml": b"<Record><RecordID>3</RecordID><FullText>\xff\xfa</FullText></Record>",
                                  "good.xml": record(4)})
    (tmp_path / "broken.zip").write_bytes(b"PK not a zip")
    archives = arc.read_archives(spark, str(tmp_path))
    good, bad = xmlsrc.split_rejects(xmlsrc.parse_records(arc.extract_members(archives, arc.list_members(archives))))
    assert sorted((r.doc_id, r.full_text) for r in good.collect()) == [(1, "café señor"), (2, "é"), (4, "t")]
    assert [(r.member, r.reason.split(":")[0]) for r in bad.collect()] == [("bad.xml", "undecodable")]
    assert [r.zip_file for r in arc.unreadable_archives(archives).collect()] == ["broken.zip"]


SOLAR = "Solar power stations store solar power for the night. Solar power grows."
FOOTBALL = "The football league final ends. The football league final was long."


def test_repeated_ids_keep_their_own_keywords(spark, tmp_path):
    land, out, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    write_zip(land, "a.zip", {"1.xml": record(1, SOLAR), "2.xml": record(2, FOOTBALL)})
    write_zip(land, "b.zip", {"1.xml": record(1, FOOTBALL)})
    vectors = emb.hashed_word_vectors(spark.createDataFrame([("solar",), ("football",)], "word string"), 4)
    ingest.run_ingest(spark, land, out, ck, files_per_trigger=2, word_vectors=vectors)
    one = spark.read.parquet(f"{out}/articles").where("doc_id = 1").collect()
    assert len(one) == 1 and one[0].full_text == SOLAR
    assert all("football" not in k.result for k in one[0].keywords)
    assert len(one[0].finished_embeddings) == 4

    write_zip(land, "c.zip", {"1.xml": record(1, FOOTBALL), "3.xml": record(3, SOLAR)})
    (tmp_path / "land" / "d.zip").write_bytes(b"broken")
    ingest.run_ingest(spark, land, out, ck, files_per_trigger=2, word_vectors=vectors)
    assert sorted(r.doc_id for r in spark.read.parquet(f"{out}/articles").collect()) == [1, 2, 3]
    assert spark.read.parquet(f"{out}/rejects").where("reason LIKE 'unreadable archive%'").count() == 1
    status = spark.read.parquet(f"{out}/status")
    before = sorted((r.batch_no, r.n_rows, r.n_rejects) for r in status.collect())
    ingest.ingest_batch(arc.read_archives(spark, land).where("path LIKE '%/c.zip' OR path LIKE '%/d.zip'"), 1, out)
    assert sorted((r.batch_no, r.n_rows, r.n_rejects) for r in spark.read.parquet(f"{out}/status").collect()) == before


def test_batches_hold_every_member(spark):
    rows = [(f"{z}.zip", f"{m}.xml") for z in range(3) for m in range(3000)]
    members = spark.createDataFrame(rows, "zip_file string, member string")
    batched = sampling.assign_batches(sampling.all_members(members), 100)
    assert batched.count() == 9000 and batched.agg(F.max("rn")).first()[0] == 8999
    assert sampling.stratified_sample(members, IngestParams(samplesize=300)).count() == 300


def test_trained_model_serves_later_queries(spark):
    texts = [(i, " ".join([w, "common", w, "words"] * 12)) for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    vectors, model = emb.embed_trained(docs, EmbeddingParams(vector_size=12), max_iter=15, min_count=5)
    assert {len(r.embedding) for r in vectors.collect()} == {12}
    queries = emb.embed_with_model(docs.select(F.col("doc_id").alias("query_id"), "text"), model, id_col="query_id")
    best = vector.knn_exact(vectors, queries, k=1).collect()
    assert all(r.query_id == r.doc_id for r in best) and len(best) == 4
    assert EmbeddingParams().vector_size == 300


def test_exact_neighbours_of_vectors_far_from_the_origin(spark):
    rng = np.random.default_rng(0)
    docs, queries = rng.normal(size=(600, 64)) + 1e4, rng.normal(size=(50, 64)) + 1e4
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "doc_id bigint, embedding array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<double>")
    got = {}
    for r in vector.knn_exact(d, q, k=5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.doc_id
    for i, v in enumerate(queries):
        dist = np.round(np.sqrt(((docs - v) ** 2).sum(axis=1)), 9)
        assert [got[i][k] for k in range(1, 6)] == np.lexsort((np.arange(600), dist))[:5].tolist()


def test_share_of_an_absent_document_and_order_of_results(spark):
    row = spark.createDataFrame([(None, None, None)], "vs double, kw double, s double")
    vec, kwp = res.fusion_share(F.col("vs"), F.col("kw"), F.col("s"))
    assert tuple(row.select(vec, kwp).first()) == (0, 0)
    articles = spark.createDataFrame([(i, "t", "p", "d", f"word{i} text") for i in range(20)],
                                     "doc_id bigint, record_title string, publisher string, alpha_pub_date string, full_text string")
    hits = spark.createDataFrame([(q, 19 - r, 0.5, 0.5, 1.0, r) for q in (2, 1) for r in (3, 1, 2)],
                                 "query_id bigint, doc_id bigint, vs_score double, kw_score double, score double, rank bigint")
    queries = spark.createDataFrame([(1, "text"), (2, "word")], "query_id bigint, text string")
    rows = [(r.query_id, r["rank"]) for r in res.search_results(articles, hits, queries).collect()]
    assert rows == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]


@pytest.mark.parametrize("data", [b"\xef\xbb\xbf<a/>", b"<a/>"])
def test_byte_order_mark(data):
    assert arc.decode_xml(data) == "<a/>"
    assert tx.SNIPPET_CONTEXT > 0


def test_groups_of_batches():
    assert ingest._groups([1, 2, 3, 5, 8], {1: 4, 2: 6, 3: 1, 8: 50}, 10) == [[1, 2], [3, 5], [8]]
    assert ingest._groups([4], {4: None}, 0) == [[4]]


def test_batches_published_in_groups_and_nothing_kept_beside_them(spark, tmp_path):
    for n in range(4):
        write_zip(tmp_path / "in", f"{n}.zip", {f"{d}.xml": record(d, f"Some text of article {d} alone.") for d in range(3 * n, 3 * n + 5)})
    write_zip(tmp_path / "in", "9.zip", {"bad.xml": "<Record><RecordID>1"})
    wv = spark.createDataFrame([("text", [1.0, 0.5]), ("alone", [0.0, 1.0])], "word string, vec array<double>")
    scratch = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before, found = set(os.listdir(scratch)), []
    for group_bytes in (1, 1 << 30):
        out = str(tmp_path / f"out{group_bytes}")
        for no, batch in enumerate(sorted(os.listdir(tmp_path / "in"))):
            ingest.cache_archives(spark.createDataFrame([(str(tmp_path / "in" / batch),)], "path string"), no, out)
        assert ingest.publish(spark, out, word_vectors=wv, group_bytes=group_bytes) == [0, 1, 2, 3, 4]
        assert ingest.publish(spark, out, word_vectors=wv, group_bytes=group_bytes) == []
        uploaded = sinks.stages(spark, out).where("stage = 'UPLOADED'")
        assert sorted(r.batch_no for r in uploaded.collect()) == [0, 1, 2, 3, 4]
        assert uploaded.select("at").distinct().count() == (5 if group_bytes == 1 else 1)
        found.append(sorted(map(str, ingest.committed_articles(spark, out).select(
            "doc_id", "zip_file", "batch_no", "full_text", "keywords", "finished_embeddings").collect())))
    assert found[0] == found[1] and len(found[0]) == 14
    left = set(os.listdir(scratch)) - before
    assert not [x for x in left if x.startswith(("parsed-", "rejects-", "places-", "word-vectors-", "new-"))]


def test_what_a_publication_shuffles_is_freed(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(ingest.sinks, "write_batch_partition", lambda df, path, f=sinks.write_batch_partition: (
        seen.append(df.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")), f(df, path)))
    write_zip(tmp_path / "in", "a.zip", {"1.xml": record(1, "One text.")})
    ingest.ingest_batch(spark.createDataFrame([(str(tmp_path / "in" / "a.zip"),)], "path string"), 0, str(tmp_path / "out"))
    assert len(seen) == 5 and set(seen) == {"true"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
