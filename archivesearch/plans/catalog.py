"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the whole driver tables.

Floating outputs are emitted rounded (distances and fused scores to 6 places,
keyword scores and reciprocal sums as ``round(ln(x), 6)``) and ids/ranks as
BIGINT so the SQL equivalents in ``plans.oracle`` compare value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivesearch.config import SearchParams
from archivesearch.operators import ann as vector_index
from archivesearch.operators import vector
from archivesearch.sources import tables

P = SearchParams()
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------------ vector

@register("knn_exact")
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = vector.knn_exact(tables.embedded_articles(spark, sf_dir),
                           tables.query_vectors(spark, sf_dir), k=P.k)
    return res.select("query_id", "doc_id", _r6(F.col("distance")).alias("distance"), "rank")


SUBSPACES = 16
SCAN = 0.8  # the fixture's vectors are nearly equidistant: recall 0.95 on sf0.1 (see ann.fit_scan)
_INDEXES: dict[tuple, vector_index.VectorIndex] = {}


def build_index(spark: SparkSession, sf_dir: str) -> vector_index.VectorIndex:
    """The index of the article vectors, with given cells and codewords (FIXTURES.md section 3)."""
    index = vector_index.create_index(spark, buckets=8)
    vector_index.give_model(index, tables.fixture_centroids(spark, sf_dir), tables.fixture_codebook(spark, sf_dir), SUBSPACES)
    vector_index.add_vectors(index, tables.embedded_articles(spark, sf_dir).withColumn("kind", F.lit("Article")))
    return index


def stored_index(spark: SparkSession, sf_dir: str) -> vector_index.VectorIndex:
    """The index of ``sf_dir``, built once in an application and then searched."""
    key = (spark.sparkContext.applicationId, *sorted(tables.table(spark, sf_dir, "embeddings").inputFiles()))
    if key not in _INDEXES:
        _INDEXES[key] = build_index(spark, sf_dir)
    return _INDEXES[key]


@register("vector_index_build")
def vector_index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index built anew: the cell and the code of every vector."""
    return build_index(spark, sf_dir).table("codes").select("doc_id", "cell", F.lower(F.hex("code")).alias("code"))


@register("vector_index_sizes")
def vector_index_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_index(spark, sf_dir).table("sizes").groupBy("kind", "cell").agg(F.sum("n").alias("n"))


@register("knn_ivf")
def knn_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = vector_index.search_index(stored_index(spark, sf_dir), tables.query_vectors(spark, sf_dir), k=P.k, candidates=P.candidates,
                           scan=SCAN, kind="Article")
    return res.select("query_id", "doc_id", _r6(F.col("distance")).alias("distance"), "rank")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query ``entry()`` runs: hybrid search once registered."""
    return REGISTRY.get("search_hybrid", REGISTRY["knn_exact"])(spark, sf_dir)


# ------------------------------------------------------------------ text

from archivesearch.config import EmbeddingParams, KeywordParams  # noqa: E402
from archivesearch.functions import text as tx  # noqa: E402
from archivesearch.operators import keywords as kw  # noqa: E402

KP = KeywordParams()


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(spark, sf_dir).select("doc_id", "text")


@register("sentences")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tx.sentences(_docs(spark, sf_dir))
    return s.select("doc_id", F.col("sent").cast("bigint").alias("sent"), "sentence")


@register("tokens")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tx.context_tokens(_docs(spark, sf_dir))
    return t.select("doc_id", F.col("sent").cast("bigint").alias("sent"),
                    F.col("chunk").cast("bigint").alias("chunk"), F.col("idx").cast("bigint").alias("idx"),
                    "term", "lft", "rgt")


@register("plain_tokens")
def plain_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tx.plain_tokens(_docs(spark, sf_dir))
    return t.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


@register("stopword_filter")
def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    kept = tx.remove_stop_words(tx.plain_token_array(F.col("text")))
    return d.select("doc_id", F.posexplode(kept).alias("pos", "token")) \
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


@register("ngrams")
def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = kw.keyword_events(tx.context_tokens(tables.by_id(_docs(spark, sf_dir))), KP, with_terms=False)
    c = kw.candidate_table(ev)
    return c.select("doc_id", F.col("kw").alias("result"), F.col("n").cast("bigint").alias("n"),
                    "tf_kw", F.col("sentence").cast("bigint").alias("sentence"))


@register("yake_terms")
def yake_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = kw.term_features(tx.context_tokens(tables.by_id(_docs(spark, sf_dir))))
    return terms.select("doc_id", "term", "tf",
                        _r6(F.ln("s_term")).alias("ln_s"))


@register("yake_keywords")
def yake_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = kw.extract_keywords(_docs(spark, sf_dir), KP)
    return k.select("doc_id", "result", _r6(F.col("ln_score")).alias("ln_score"),
                    F.col("sentence").cast("bigint").alias("sentence"), "kw_rank")


@register("keywords_nested")
def keywords_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    nested = kw.nest_keywords(d.select("doc_id"), kw.extract_keywords(d, KP))
    return nested.select("doc_id", F.posexplode_outer("keywords").alias("kpos", "k")) \
                 .select("doc_id", F.col("kpos").cast("bigint").alias("kpos"),
                         F.col("k.result").alias("result"))


@register("query_keywords")
def query_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.query_keywords(tables.query_texts(spark, sf_dir), KP)


@register("clean_query")
def clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = tables.query_texts(spark, sf_dir)
    return q.select("query_id", tx.clean_query(F.col("text")).alias("cleaned"))


@register("clean_text")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


def _query_regex_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cleaned (P2), with the match regex (P1 + P3) of one of the query texts:
    the one whose id is the document's modulo the number of queries."""
    q = tables.query_texts(spark, sf_dir)
    n = q.select(F.count(F.lit(1))).scalar()
    d = _docs(spark, sf_dir).withColumn("query_id", F.pmod(F.col("doc_id"), n))
    regex = q.select("query_id", tx.query_regex(tx.clean_query(F.col("text"))).alias("re"))
    return d.join(regex, "query_id").select("doc_id", tx.clean_text(F.col("text")).alias("ctext"), "re")


@register("highlight")
def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _query_regex_docs(spark, sf_dir)
    return d.select("doc_id", "re", tx.highlight(F.col("ctext"), F.col("re")).alias("highlighted"))


@register("snippet")
def snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _query_regex_docs(spark, sf_dir)
    return d.select("doc_id", "re", tx.snippet(F.col("ctext"), F.col("re")).alias("snippet"))


# ------------------------------------------------------------------ search

from archivesearch.operators import collection as coll  # noqa: E402
from archivesearch.operators import embeddings as emb  # noqa: E402
from archivesearch.operators import fusion, lexical, wordvec  # noqa: E402
from archivesearch.session import materialize  # noqa: E402

WV_DIM = 16


def _kw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword table of pre-filtered articles (what ingest persists)."""
    return materialize(kw.extract_keywords(tables.article_texts(spark, sf_dir), KP))


def _all_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword table of every document: annotation does not filter, searches do."""
    return kw.extract_keywords(_docs(spark, sf_dir), KP)


_BUILT: dict[tuple, coll.Collection] = {}
_HYBRID_INDEXES: dict[str, vector_index.VectorIndex] = {}


def stored_collection(spark: SparkSession, sf_dir: str) -> coll.Collection:
    """The collection of all documents of ``sf_dir``, built once in an application and then searched."""
    key = (spark.sparkContext.applicationId, *sorted(tables.table(spark, sf_dir, "documents").inputFiles()))
    if key not in _BUILT:
        _BUILT[key] = build_collection(spark, sf_dir)
    return _BUILT[key]


def build_collection(spark: SparkSession, sf_dir: str) -> coll.Collection:
    d = tables.articles(spark, sf_dir, prefilter=False)
    size = d.agg(F.coalesce(F.sum(F.octet_length("full_text")), F.lit(0))).first()[0]
    buckets = max(8, -(-size // (64 << 20)))  # postings take about twice the bytes of the texts
    return coll.add_articles(coll.create_collection(spark, buckets=buckets), d.withColumn("is_article", tables.article_filter()),
                             _word_vectors(spark, sf_dir), KP)


def _query_ngrams(spark: SparkSession, sf_dir: str, cleaned: bool = False) -> DataFrame:
    return kw.query_keywords(_queries(spark, sf_dir, cleaned), KP).select("query_id", "result")


def _queries(spark: SparkSession, sf_dir: str, cleaned: bool = False) -> DataFrame:
    q = tables.query_texts(spark, sf_dir)
    if cleaned:
        q = q.select("query_id", tx.clean_query(F.col("text")).alias("text"))
    return q


def _word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = (tables.documents(spark, sf_dir).select("text")
             .unionByName(tables.table(spark, sf_dir, "benchmark").select("text"))
             .select(F.explode(tx.plain_token_array(F.col("text"))).alias("word"))
             .distinct())
    return emb.hashed_word_vectors(words, WV_DIM)


def _vector_arm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coll.search_vector(stored_collection(spark, sf_dir), _queries(spark, sf_dir, True), P)


def _keyword_arm(spark: SparkSession, sf_dir: str, cleaned: bool = True) -> DataFrame:
    return coll.search_phrase(stored_collection(spark, sf_dir), _query_ngrams(spark, sf_dir, cleaned), P)


def _hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coll.search_hybrid(stored_collection(spark, sf_dir), _queries(spark, sf_dir, True), P, KP)


def _emit_fused(df: DataFrame) -> DataFrame:
    return df.select("query_id", "doc_id", _r6(F.col("vs_score")).alias("vs_score"),
                     _r6(F.col("kw_score")).alias("kw_score"), _r6(F.col("score")).alias("score"), "rank")


@register("filter_object_type")
def filter_object_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = tables.articles(spark, sf_dir, prefilter=False)
    return lexical.prefilter_object_type(a).select("doc_id", "record_title")


@register("project_nested")
def project_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = kw.nest_keywords(_docs(spark, sf_dir).select("doc_id"), _all_keywords(spark, sf_dir))
    p = lexical.project_nested(nested)
    return p.select("doc_id", F.array_join("results", "|").alias("results"),
                    F.size("scores").cast("bigint").alias("n_scores"))


@register("unnest_keywords")
def unnest_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = kw.nest_keywords(_docs(spark, sf_dir).select("doc_id"), _all_keywords(spark, sf_dir))
    u = lexical.unnest_keywords(nested)
    return u.select("doc_id", "result", _r6(F.ln("score")).alias("ln_score"))


@register("match_ngrams")
def match_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lexical.match_ngrams(_kw_store(spark, sf_dir), _query_ngrams(spark, sf_dir))
    return m.select("query_id", "doc_id", "result")


@register("distinct_matches")
def distinct_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lexical.distinct_matches(lexical.match_ngrams(_kw_store(spark, sf_dir), _query_ngrams(spark, sf_dir)))
    return m.select("query_id", "doc_id", "result", _r6(F.col("ln_score")).alias("ln_score"))


@register("matched_set")
def matched_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lexical.match_ngrams(_kw_store(spark, sf_dir), _query_ngrams(spark, sf_dir))
    return m.groupBy("query_id", "doc_id").agg(
        F.array_join(F.sort_array(F.collect_set("result")), "|").alias("keywords"))


@register("reciprocal_score")
def reciprocal_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _all_keywords(spark, sf_dir)
    return s.select("doc_id", "result",
                    _r6(F.ln(lexical.tolerant_reciprocal(F.col("score")))).alias("ln_recip"))


@register("search_keyword")
def search_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = coll.search_keyword(stored_collection(spark, sf_dir), _query_ngrams(spark, sf_dir), P)
    return r.select("query_id", "doc_id", _r6(F.col("ln_score")).alias("ln_score"),
                    F.array_join("keywords", "|").alias("keywords"), "rank")


@register("collection_build")
def collection_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection built anew: documents with keywords and their keyword tokens, of articles and of the rest."""
    c = build_collection(spark, sf_dir)
    return c.table("totals").withColumn("is_article", F.lit(True)).unionByName(
        c.table("totals", articles=False).withColumn("is_article", F.lit(False))).groupBy("is_article").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("dl").alias("dl"))


@register("collection_postings")
def collection_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_collection(spark, sf_dir).table("postings").select("phrase", "doc_id", "tf", "dl")


@register("collection_phrases")
def collection_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_collection(spark, sf_dir).table("phrases").groupBy("phrase").agg(F.sum("n").alias("df"))


@register("topk_per_query")
def topk_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = coll.search_keyword(stored_collection(spark, sf_dir), _query_ngrams(spark, sf_dir), P)
    return r.select("query_id", "doc_id", "rank")


@register("topk_global")
def topk_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best (lowest-score) keywords of the whole store: one ordered top-k."""
    s = _all_keywords(spark, sf_dir)
    return (s.orderBy(F.round("ln_score", 9).asc(), F.col("doc_id").asc(), F.col("result").asc())
            .limit(P.k).select("doc_id", "result", _r6(F.col("ln_score")).alias("ln_score")))


@register("search_phrase_bm25")
def search_phrase_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _keyword_arm(spark, sf_dir, cleaned=False)
    return r.select("query_id", "doc_id", _r6(F.col("score")).alias("score"), "rank")


@register("embed_from_table")
def embed_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = emb.embed_from_table(_docs(spark, sf_dir), _word_vectors(spark, sf_dir))
    return v.select("doc_id", F.posexplode_outer("embedding").alias("dim", "value")) \
            .select("doc_id", F.col("dim").cast("bigint").alias("dim"), _r6(F.col("value")).alias("value"))


@register("embed_trained")
def embed_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, _ = wordvec.embed_spectral(_docs(spark, sf_dir), EmbeddingParams())
    return v.select("doc_id", F.size("embedding").cast("bigint").alias("dims"))


@register("embed_finish")
def embed_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = emb.embed_from_table(_docs(spark, sf_dir), _word_vectors(spark, sf_dir))
    wrapped = v.select("doc_id", F.when(F.col("embedding").isNotNull(), F.array("embedding")).alias("ann"))
    fin = wrapped.select("doc_id", emb.finish(F.col("ann")).alias("finished"))
    return fin.select("doc_id", F.posexplode("finished").alias("dim", "value")) \
              .select("doc_id", F.col("dim").cast("bigint").alias("dim"),
                      _r6(F.col("value").cast("double")).alias("value"))


@register("arm_rank")
def arm_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.arm_rank(_vector_arm(spark, sf_dir)).select("query_id", "doc_id", "arm_rank")


@register("rrf_contribution")
def rrf_contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = fusion.scored_arm(_vector_arm(spark, sf_dir), "contribution", P.vector_penalty) \
        .withColumn("arm", F.lit("vector"))
    k = fusion.scored_arm(_keyword_arm(spark, sf_dir), "contribution", P.keyword_penalty) \
        .withColumn("arm", F.lit("keyword"))
    return v.unionByName(k).select("query_id", "doc_id", "arm", _r6(F.col("contribution")).alias("contribution"))


@register("union_arms")
def union_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = fusion.union_arms([fusion.scored_arm(_vector_arm(spark, sf_dir), "vs_score", P.vector_penalty),
                           fusion.scored_arm(_keyword_arm(spark, sf_dir), "kw_score", P.keyword_penalty)])
    return u.select("query_id", "doc_id", _r6(F.col("vs_score")).alias("vs_score"),
                    _r6(F.col("kw_score")).alias("kw_score"))


@register("merge_arms")
def merge_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = fusion.union_arms([fusion.scored_arm(_vector_arm(spark, sf_dir), "vs_score", P.vector_penalty),
                           fusion.scored_arm(_keyword_arm(spark, sf_dir), "kw_score", P.keyword_penalty)])
    m = fusion.merge_arms(u, ["vs_score", "kw_score"])
    return m.select("query_id", "doc_id", _r6(F.col("vs_score")).alias("vs_score"),
                    _r6(F.col("kw_score")).alias("kw_score"))


@register("search_hybrid")
def search_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emit_fused(_hybrid(spark, sf_dir))


@register("search_hybrid_ivf")
def search_hybrid_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over the candidate budget: the vector arm re-ranks 100 codes of half of the vectors (V2)."""
    c = stored_collection(spark, sf_dir)
    if c.path not in _HYBRID_INDEXES:  # the vectors of the first 16 and 64 documents are the given cells and codewords
        first = c.table("vectors").orderBy("doc_id").limit(64).withColumn("no", F.row_number().over(Window.orderBy("doc_id")) - 1)
        cells = first.where("no < 16").select(F.col("no").cast("bigint").alias("cell"), F.col("embedding").alias("centroid"))
        _HYBRID_INDEXES[c.path] = coll.index_vectors(
            c, materialize(cells), materialize(first.select(F.col("no").alias("code"), F.col("embedding").alias("value"))), subspaces=4)
    return _emit_fused(coll.search_hybrid(c, _queries(spark, sf_dir, True), P, KP, index=_HYBRID_INDEXES[c.path], scan=0.5))


@register("rrf_three_arms")
def rrf_three_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kw_l1 = coll.search_keyword(stored_collection(spark, sf_dir), _query_ngrams(spark, sf_dir, True), P)
    r = fusion.rrf([(_vector_arm(spark, sf_dir), "vs_score", P.vector_penalty),
                    (_keyword_arm(spark, sf_dir), "kw_score", P.keyword_penalty),
                    (kw_l1, "l1_score", P.keyword_penalty)], P.k)
    return r.select("query_id", "doc_id", _r6(F.col("vs_score")).alias("vs_score"),
                    _r6(F.col("kw_score")).alias("kw_score"), _r6(F.col("l1_score")).alias("l1_score"),
                    _r6(F.col("score")).alias("score"), "rank")


# ------------------------------------------------------------------ results

from archivesearch.operators import annotate as ann  # noqa: E402
from archivesearch.operators import results as res  # noqa: E402


@register("fetch_ranked")
def fetch_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = materialize(_hybrid(spark, sf_dir))
    f = res.fetch_ranked(coll.fetch_texts(stored_collection(spark, sf_dir), hits), hits)
    return f.select("query_id", "rank", "doc_id", "record_title", "publisher")


@register("fusion_share")
def fusion_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hybrid(spark, sf_dir)
    vec, kwp = res.fusion_share(F.col("vs_score"), F.col("kw_score"), F.col("score"))
    return h.select("query_id", "doc_id", vec.alias("vec_pct"), kwp.alias("kw_pct"))


@register("search_results")
def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coll.search(stored_collection(spark, sf_dir), tables.query_texts(spark, sf_dir), P, KP).rows


@register("query_status")
def query_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coll.search(stored_collection(spark, sf_dir), tables.query_texts(spark, sf_dir), P, KP).status


@register("annotate_articles")
def annotate_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = tables.articles(spark, sf_dir, prefilter=False).select("doc_id", "full_text")
    out = ann.annotate(a, _word_vectors(spark, sf_dir), KP)
    return out.select("doc_id", F.coalesce(F.size("keywords"), F.lit(0)).cast("bigint").alias("n_keywords"),
                      F.coalesce(F.size("finished_embeddings"), F.lit(0)).cast("bigint").alias("dims"))


# ------------------------------------------------------------------ ingest

from archivesearch.config import IngestParams  # noqa: E402
from archivesearch.operators import sampling  # noqa: E402
from archivesearch.session import scratch_path  # noqa: E402
from archivesearch.sources import archives as arc  # noqa: E402
from archivesearch.sources import sinks  # noqa: E402
from archivesearch.sources import xml as xmlsrc  # noqa: E402
from archivesearch.sources import zip_source as zipsrc  # noqa: E402
from archivesearch.streaming import ingest as stream_ingest  # noqa: E402

# sampling is the feature of one query: a sample smaller than the archive set, so
# that quotas take effect; all other queries take every member
SAMPLE = IngestParams(samplesize=500)
BATCH = 100


def _records(spark: SparkSession, sf_dir: str, truncate_mod: int = 0, repeat_mod: int = 0,
             publisher_en_only: bool = False) -> DataFrame:
    """Documents as one ``<Record>`` XML member each (FIXTURES.md section 4)."""
    d = tables.documents(spark, sf_dir)
    base = F.when(F.col("lang") == tables.ARTICLE_LANG, F.lit("Article")).otherwise(F.col("lang"))
    ot = F.array(base)
    if repeat_mod:
        ot = F.when(F.col("doc_id") % repeat_mod == 0, F.array(base, F.lit("Archive"))).otherwise(ot)
    pub = F.col("source")
    if publisher_en_only:
        pub = F.when(F.col("lang") == tables.ARTICLE_LANG, pub)
    xml = xmlsrc.to_record_xml(F.col("doc_id"), F.substring("text", 1, tables.TITLE_CHARS), pub,
                               F.lit(tables.PUB_DATE), ot, F.col("text"))
    if truncate_mod:
        xml = F.when(F.col("doc_id") % truncate_mod == 0,
                     F.substring(xml, 1, (F.length(xml) / 2).cast("int"))).otherwise(xml)
    return d.select("doc_id", F.col("source").alias("archive"),
                    F.concat(F.col("doc_id").cast("string"), F.lit(".xml")).alias("member"),
                    xml.alias("xml"))


def _archives(spark: SparkSession, sf_dir: str, **kw_) -> DataFrame:
    return arc.build_archives(_records(spark, sf_dir, **kw_), piece_bytes=4 << 20)


def _archive_folder(spark: SparkSession, sf_dir: str, **kw_) -> str:
    """The archives as zip files in the shared folder."""
    folder = scratch_path(spark, "archives")
    zipsrc.write_archives(_archives(spark, sf_dir, **kw_), folder)
    return folder


def _entries(spark: SparkSession, sf_dir: str, **kw_) -> DataFrame:
    return zipsrc.read_entries(spark, _archive_folder(spark, sf_dir, **kw_))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(spark, sf_dir).where("error IS NULL").select("zip_file", "member")


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every member in batches."""
    return sampling.assign_batches(sampling.all_members(_members(spark, sf_dir)), BATCH)


def _parsed_batches(spark: SparkSession, sf_dir: str, **kw_) -> DataFrame:
    entries = materialize(_entries(spark, sf_dir, **kw_))
    s = sampling.assign_batches(sampling.all_members(entries.select("zip_file", "member")), BATCH)
    chosen = entries.join(s.select("zip_file", "member", "batch_no"), ["zip_file", "member"])
    return xmlsrc.parse_records(zipsrc.read_records(chosen))


@register("archive_members")
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir)


@register("stratified_sample")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sampling.stratified_sample(_members(spark, sf_dir), SAMPLE)
    return s.select("zip_file", "member", "in_zip_rank")


@register("batch_assign")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select("zip_file", "member", "rn", "batch_no")


@register("first_batch")
def first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.first_batch(_batched(spark, sf_dir)).select("zip_file", "member")


@register("archive_extract")
def archive_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = zipsrc.read_records(_entries(spark, sf_dir))
    return ex.select("zip_file", "member",
                     F.regexp_extract("xml", r"<RecordID>(\d+)</RecordID>", 1).cast("bigint").alias("doc_id"))


@register("xml_records")
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = xmlsrc.split_rejects(xmlsrc.parse_records(zipsrc.read_records(_entries(spark, sf_dir))))
    return good.select("zip_file", "member", "doc_id", "record_title", "publisher", "alpha_pub_date",
                       F.array_join("object_type", "|").alias("object_type"),
                       F.md5("full_text").alias("text_md5"))


@register("xml_rejects")
def xml_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _records(spark, sf_dir, truncate_mod=10).select("member", "xml")
    _, bad = xmlsrc.split_rejects(xmlsrc.parse_records(recs))
    return bad.select("member", "reason")


@register("schema_union")
def schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _records(spark, sf_dir, repeat_mod=7, publisher_en_only=True).select("member", "xml")
    good, _ = xmlsrc.split_rejects(xmlsrc.parse_records(recs))
    return good.select("doc_id", "publisher", F.size("object_type").cast("bigint").alias("n_types"))


@register("cache_roundtrip")
def cache_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = xmlsrc.split_rejects(_parsed_batches(spark, sf_dir))
    back = sinks.cache_batch(good.select("doc_id", "zip_file", "member", "full_text", "batch_no"),
                             scratch_path(spark, "cache"))
    return back.select("doc_id", F.col("batch_no").cast("bigint").alias("batch_no"))


@register("append_idempotent")
def append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = xmlsrc.split_rejects(_parsed_batches(spark, sf_dir))
    good = materialize(good.select("doc_id", "zip_file", "member", "publisher", "batch_no"))
    path = scratch_path(spark, "collection")
    sinks.append_batch(good, path)
    sinks.append_batch(good, path)  # a re-run of the same batches must not duplicate
    back = sinks.read_collection(spark, path)
    return back.groupBy(F.col("batch_no").cast("bigint").alias("batch_no")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("batch_status")
def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = sinks.batch_status(_parsed_batches(spark, sf_dir, truncate_mod=10))
    return st.select("batch_no", "stage", "n_rows", "n_rejects")


@register("incremental_ingest")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _archive_folder(spark, sf_dir)
    out = scratch_path(spark, "ingested")
    stream_ingest.run_ingest(spark, landing, out, scratch_path(spark, "stream-ckpt"), files_per_trigger=2,
                             word_vectors=_word_vectors(spark, sf_dir))
    arts = sinks.read_collection(spark, out + "/articles")
    return arts.select("doc_id", F.coalesce(F.size("keywords"), F.lit(0)).cast("bigint").alias("n_keywords"),
                       F.coalesce(F.size("finished_embeddings"), F.lit(0)).cast("bigint").alias("dims"))


@register("ingest_stages")
def ingest_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 over a whole ingest: records and batches that reached each stage, and files that failed."""
    out = scratch_path(spark, "ingested")
    stream_ingest.run_ingest(spark, _archive_folder(spark, sf_dir, truncate_mod=10), out, scratch_path(spark, "stream-ckpt"),
                             files_per_trigger=8, annotate=False)
    status = spark.read.parquet(out + "/status").select(F.col("batch_no").cast("bigint").alias("batch_no"), "n_rows", "n_rejects")
    reached = sinks.stages(spark, out).select("batch_no", "stage").distinct().join(status, "batch_no").unionByName(
        status.withColumn("stage", F.lit("PROCESSED"))).groupBy("stage").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_rejects").alias("n_rejects"))
    failed = spark.read.parquet(out + "/failed").groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_rejects").alias("n_rejects"))
    return reached.unionByName(failed)


@register("ingest_sampled")
def ingest_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1-B4 in one flow: sample, batches, ingest; where every stored article is."""
    out = scratch_path(spark, "ingested")
    stream_ingest.ingest_sample(spark, _archive_folder(spark, sf_dir), out, IngestParams(samplesize=SAMPLE.samplesize, batchsize=BATCH),
                                annotate=False)
    return stream_ingest.committed_articles(spark, out).select("doc_id", "zip_file", "member", "batch_no")
