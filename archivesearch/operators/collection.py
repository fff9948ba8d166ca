"""A stored, searchable collection: built once (or batch by batch), searched many times.

``add_articles`` annotates a batch once and appends it to Parquet tables below one folder, apart for
articles and other records (the pre-filter, X1, chooses tables instead of reading rows):

- ``keywords`` (result, part, doc_id, score, ln_score) and ``results`` (result, n, parts);
- ``postings`` (phrase, part, doc_id, tf, dl), every sub-phrase of every keyword, and ``phrases``
  (phrase, n, parts): in how many documents;
- ``totals`` (n_docs, dl): documents with keywords and their keyword tokens;
- ``vectors`` (doc_id, embedding) and ``texts`` (what result rows show, in order of id, so that a look-up
  of ids reads a few pages);
- ``words`` (word, vec): the word vectors, for the queries.

Keywords, postings and their counts are bucketed and sorted by what searches look up, so a search
shuffles the rows of the queries and never those of the collection. Counts are partial: a batch adds its
own, and a search sums them. A result or phrase in more than ``part_rows`` documents of a batch is
dealt into ``parts`` by the document's hash, each in a bucket of its own, so that no bucket (and no task)
holds a hot phrase's whole list; the counts say how many parts to look up.

Searches (L1, L2, V1, F1) read these tables only. A batch whose ids are all new is the caller's
concern (``sinks.new_documents``); null ids and texts are left out.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivesearch.config import KeywordParams, SearchParams
from archivesearch.functions import text as tx
from archivesearch.operators import embeddings as emb
from archivesearch.operators import ann, fusion, lexical, results, vector
from archivesearch.operators import keywords as kw
from archivesearch.session import scratch_path

#: Columns and bucketing keys of the tables of each kind of record.
TABLES = {
    "keywords": ("result string, part int, doc_id bigint, score double, ln_score double", ["result", "part"]),
    "results": ("result string, n bigint, parts int", ["result"]),
    "postings": ("phrase string, part int, doc_id bigint, tf bigint, dl bigint", ["phrase", "part"]),
    "phrases": ("phrase string, n bigint, parts int", ["phrase"]),
    "totals": ("n_docs bigint, dl bigint", []),
    "vectors": ("doc_id bigint, embedding array<double>", []),
    "texts": ("doc_id bigint, record_title string, publisher string, alpha_pub_date string, full_text string", []),
}
WORDS = ("word string, vec array<double>", ["word"])
ARTICLE_COLUMNS = ["doc_id", "is_article", "record_title", "publisher", "alpha_pub_date", "full_text"]


@dataclass(frozen=True)
class Collection:
    """Handle of the tables below ``path``; ``name`` starts their names in the session's catalog."""

    spark: SparkSession
    path: str
    buckets: int
    name: str
    part_rows: int = 1_000_000

    def _place(self, table: str, articles: bool) -> str:
        return f"{self.path}/{table}" if table == "words" else f"{self.path}/{table}/is_article={str(articles).lower()}"

    def _entry(self, table: str, articles: bool) -> str:
        return f"{self.name}_{table}" if table == "words" else f"{self.name}_{table}_{str(articles).lower()}"

    def table(self, table: str, articles: bool = True) -> DataFrame:
        return self.spark.table(self._entry(table, articles))

    def append(self, table: str, rows: DataFrame, articles: bool = True) -> None:
        schema, keys = WORDS if table == "words" else TABLES[table]
        rows = rows.select(*[c.split()[0] for c in schema.split(", ")])
        if keys:
            rows = rows.repartition(self.buckets, *keys)
            rows.write.mode("append").bucketBy(self.buckets, *keys).sortBy(*keys).format("parquet").option(
                "path", self._place(table, articles)).saveAsTable(self._entry(table, articles))
        else:
            # small row groups and pages with bounds, and Bloom filters, on the id: a look-up reads the pages of its ids
            rows.write.mode("append").options(
                **{"parquet.bloom.filter.enabled#doc_id": "true", "parquet.block.size": str(8 << 20), "parquet.page.size": str(64 << 10),
                   "parquet.page.row.count.limit": "200"}).parquet(self._place(table, articles))  # a table's own options would replace them
            self.spark.catalog.refreshTable(self._entry(table, articles))


def _registered(collection: Collection) -> Collection:
    """Enter the tables into the session's catalog; their files may be there already."""
    for articles in (True, False):
        for table, (schema, keys) in (TABLES | ({"words": WORDS} if articles else {})).items():
            by = ", ".join(keys)
            clustered = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {collection.buckets} BUCKETS" if keys else ""
            collection.spark.sql(f"CREATE TABLE IF NOT EXISTS {collection._entry(table, articles)} ({schema}) USING parquet "
                                 f"{clustered} LOCATION '{collection._place(table, articles)}'")
    return collection


def create_collection(spark: SparkSession, path: str | None = None, buckets: int = 16, part_rows: int = 1_000_000) -> Collection:
    """An empty collection. ``buckets``: files that a batch adds to a bucketed table; about the batch's postings in
    bytes over 128 MB for a large one."""
    path = path or scratch_path(spark, "collection")
    spark.createDataFrame([(buckets, part_rows)], "buckets int, part_rows bigint").coalesce(1).write.json(f"{path}/settings")
    return open_collection(spark, path)


def open_collection(spark: SparkSession, path: str) -> Collection:
    """The collection that an earlier session, or this one, made at ``path``."""
    own = spark.read.schema("buckets int, part_rows bigint").json(f"{path}/settings").first()
    return _registered(Collection(spark, path, own.buckets, f"collection_{uuid.uuid4().hex}", own.part_rows))


def _dealt(rows: DataFrame, key: str, part_rows: int, staged: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the ``part`` of each, and the counts ``(key, n, parts)``. Counts and hot keys are written below
    ``staged``: they are counted once, and the few hot keys are seen to be few, so that ``rows`` need no shuffle to meet them."""
    spark = rows.sparkSession
    rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / F.lit(part_rows)).cast("int")).write.parquet(f"{staged}-counts")
    counts = spark.read.schema(f"{key} string, n bigint, parts int").parquet(f"{staged}-counts")
    counts.where("parts > 1").select(key, "parts").coalesce(1).write.parquet(f"{staged}-hot")  # at most rows / part_rows
    hot = spark.read.schema(f"{key} string, parts int").parquet(f"{staged}-hot")
    dealt = rows.join(hot, key, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"), F.lit(0)))
    return dealt.drop("parts"), counts


def add_articles(collection: Collection, articles: DataFrame, word_vectors: DataFrame | None = None,
                 params: KeywordParams = KeywordParams(), staged: str | None = None) -> Collection:
    """Annotate a batch ``ARTICLE_COLUMNS`` and append it. ``word_vectors(word, vec)``: those that the collection does
    not have yet, also for words of queries to come; without any, vectors come from the ones it has."""
    spark = collection.spark
    staged = staged or scratch_path(spark, "batch")
    if word_vectors is not None:
        have = collection.table("words").select("word")
        collection.append("words", word_vectors.join(have, "word", "left_anti"))
    articles = articles.select(*ARTICLE_COLUMNS).where("doc_id IS NOT NULL AND full_text IS NOT NULL")
    keyed = articles.select(F.struct("doc_id", F.coalesce("is_article", F.lit(False)).alias("is_article")).alias("key"),
                            F.col("full_text").alias("text"))
    kw.extract_keywords(keyed, params, id_col="key").select(
        "key.*", "result", "score", "ln_score").write.partitionBy("is_article").parquet(f"{staged}/keywords")
    every = spark.read.schema("doc_id bigint, result string, score double, ln_score double, is_article boolean").parquet(
        f"{staged}/keywords")
    for flag in (True, False):
        own = articles.where(F.coalesce("is_article", F.lit(False)) == F.lit(flag))
        found = every.where(F.col("is_article") == F.lit(flag)).drop("is_article")
        dealt, counts = _dealt(found, "result", collection.part_rows, f"{staged}/results-{flag}")
        collection.append("keywords", dealt, flag)
        collection.append("results", counts, flag)
        length = F.size(F.split("result", " "))
        of_doc = found.groupBy("doc_id").agg(F.collect_list("result").alias("found"), F.sum(length).alias("dl"))
        postings = lexical.sub_phrases(of_doc.select("doc_id", "dl", F.explode("found").alias("result"))).groupBy(
            "doc_id", "dl", "phrase").agg(F.count(F.lit(1)).alias("tf"))
        postings.write.parquet(f"{staged}/postings-{flag}")
        postings = spark.read.schema("doc_id bigint, dl bigint, phrase string, tf bigint").parquet(f"{staged}/postings-{flag}")
        dealt, counts = _dealt(postings, "phrase", collection.part_rows, f"{staged}/phrases-{flag}")
        collection.append("postings", dealt, flag)
        collection.append("phrases", counts, flag)
        collection.append("totals", of_doc.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl")), flag)
        vectors = emb.embed_from_table(own.select("doc_id", F.col("full_text").alias("text")), collection.table("words"))
        collection.append("vectors", vectors.where("embedding IS NOT NULL"), flag)
        collection.append("texts", own.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), flag)
    return collection


def _located(collection: Collection, wanted: DataFrame, key: str, counts: str, articles: bool) -> DataFrame:
    """``wanted(query_id, key)`` with the summed ``df`` of the key and one row for each of its parts."""
    found = wanted.join(collection.table(counts, articles), key).groupBy("query_id", key).agg(
        F.sum("n").alias("df"), F.max("parts").alias("parts"))
    return found.select("query_id", key, "df", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))


def search_keyword(collection: Collection, query_ngrams: DataFrame, params: SearchParams = SearchParams(),
                   articles: bool = True) -> DataFrame:
    """L1 over the stored keywords: (query_id, doc_id, score, keywords, rank)."""
    q = query_ngrams.select("query_id", "result").distinct()
    hits = collection.table("keywords", articles).join(_located(collection, q, "result", "results", articles), ["result", "part"])
    return lexical.score_matches(hits, params)


def search_phrase(collection: Collection, query_ngrams: DataFrame, params: SearchParams = SearchParams(),
                  articles: bool = True) -> DataFrame:
    """L2 over the stored postings: (query_id, doc_id, score, rank)."""
    q = query_ngrams.select("query_id", F.col("result").alias("phrase")).distinct()
    hits = collection.table("postings", articles).join(_located(collection, q, "phrase", "phrases", articles), ["phrase", "part"])
    totals = collection.table("totals", articles)
    n_docs = totals.select(F.sum("n_docs").cast("double")).scalar()
    avgdl = totals.select(F.sum("dl") / F.nullif(F.sum("n_docs"), F.lit(0))).scalar()
    return lexical.bm25_top_k(hits, n_docs, avgdl, params)


def query_vectors(collection: Collection, queries: DataFrame) -> DataFrame:
    """V0: (query_id, embedding) of the queries that have a known word."""
    return emb.embed_from_table(queries, collection.table("words"), id_col="query_id").where("embedding IS NOT NULL")


def index_vectors(collection: Collection, cells: DataFrame | None = None, codebook: DataFrame | None = None, subspaces: int = 16,
                  articles: bool = True) -> ann.VectorIndex:
    """V3 of the stored vectors: a stored index with a trained model, or with given ``cells(cell, centroid)`` and
    ``codebook(code, value)``. Vectors of later batches are added with ``ann.add_vectors``."""
    index = ann.create_index(collection.spark, f"{collection._place('index', articles)}-{uuid.uuid4().hex}", collection.buckets)
    vectors = collection.table("vectors", articles)
    if cells is None or codebook is None:
        ann.train_model(index, vectors, subspaces=subspaces)
    else:
        ann.give_model(index, cells, codebook, subspaces)
    ann.add_vectors(index, vectors)
    return index


def search_vector(collection: Collection, queries: DataFrame, params: SearchParams = SearchParams(), articles: bool = True,
                  index: ann.VectorIndex | None = None, scan: float = 0.1) -> DataFrame:
    """V0 and V1, or V2 with an ``index`` and its share of codes to look at: (query_id, doc_id, distance, rank)."""
    asked = query_vectors(collection, queries)
    if index is not None:
        return ann.search_index(index, asked, params.k, params.candidates, scan)
    return vector.knn_exact(collection.table("vectors", articles), asked, k=params.k)


def search_hybrid(collection: Collection, queries: DataFrame, params: SearchParams = SearchParams(),
                  keyword_params: KeywordParams = KeywordParams(), articles: bool = True,
                  index: ann.VectorIndex | None = None, scan: float = 0.1) -> DataFrame:
    """F1 for ``queries(query_id, text)``: (query_id, doc_id, vs_score, kw_score, score, rank). With an ``index`` the
    vector arm re-ranks ``params.candidates`` of its codes."""
    ngrams = kw.query_keywords(queries, keyword_params).select("query_id", "result")
    return fusion.hybrid(search_vector(collection, queries, params, articles, index, scan),
                         search_phrase(collection, ngrams, params, articles), params)


def fetch_texts(collection: Collection, hits: DataFrame, articles: bool = True, look_up: int = 10_000) -> DataFrame:
    """The stored texts of ``hits(doc_id)``. Up to ``look_up`` ids are looked up in the tables in order of id, whose
    bounds and Bloom filters leave the pages that hold them; more ids than that are joined with the whole table."""
    texts = collection.table("texts", articles)
    ids = [r.doc_id for r in hits.select("doc_id").distinct().limit(look_up + 1).collect()]  # k of each query
    if len(ids) <= look_up:
        return texts.where(F.col("doc_id").isin(ids))
    return texts.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")


@dataclass(frozen=True)
class SearchResult:
    rows: DataFrame    # P7, in fused-rank order
    status: DataFrame  # P8


def search(collection: Collection, queries: DataFrame, params: SearchParams = SearchParams(),
           keyword_params: KeywordParams = KeywordParams(), articles: bool = True) -> SearchResult:
    """One call from raw query texts to what is shown: clean (P1), hybrid search (F1), fetch in rank order (S9),
    snippets, shares and highlighted texts (P2-P7), and a status of each query (P8)."""
    cleaned = queries.select("query_id", tx.clean_query(F.col("text")).alias("text"))
    spark = collection.spark
    at = scratch_path(spark, "hits")
    search_hybrid(collection, cleaned, params, keyword_params, articles).write.parquet(at)  # rows and status read it
    hits = spark.read.schema("query_id bigint, doc_id bigint, vs_score double, kw_score double, score double, rank bigint").parquet(at)
    return SearchResult(results.search_results(fetch_texts(collection, hits, articles), hits, queries),
                        results.query_status(queries, hits))
