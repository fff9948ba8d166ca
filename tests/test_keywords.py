"""Keyword extraction properties and embeddings."""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from archivesearch.config import KeywordParams
from archivesearch.functions.stopwords import ENGLISH_STOP_WORDS
from archivesearch.functions.text import CHUNK_MARK, context_tokens
from archivesearch.operators import embeddings as emb
from archivesearch.operators import keywords as kw

TEXT = ("Apache Spark is a unified engine for large-scale data processing. "
        "Spark runs on clusters, and the Spark engine scales to big data. "
        "Data engineers use Spark for ETL.\nNASA uses big data too!")


def test_yake_properties(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "..."), (3, None)], "doc_id bigint, text string")
    k = kw.extract_keywords(df, KeywordParams(num_keywords=5)).collect()
    assert len(k) == 5 and {r.doc_id for r in k} == {1}
    assert [r.kw_rank for r in sorted(k, key=lambda r: r.kw_rank)] == [1, 2, 3, 4, 5]
    for r in k:
        words = r.result.split(" ")
        assert 1 <= len(words) <= 3
        assert words[0] not in ENGLISH_STOP_WORDS and words[-1] not in ENGLISH_STOP_WORDS
        assert r.score > 0 and r.result == r.result.lower()
    scores = [r.ln_score for r in sorted(k, key=lambda r: r.kw_rank)]
    assert scores == sorted(scores)
    assert "spark" in {r.result for r in k}


def test_nested_keeps_documents_without_keywords(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "...")], "doc_id bigint, text string")
    nested = kw.nest_keywords(df.select("doc_id"), kw.extract_keywords(df))
    got = {r.doc_id: r.keywords for r in nested.collect()}
    assert got[2] is None and len(got[1]) == 20
    assert [x.result for x in got[1]][:1] == [kw.extract_keywords(df).where("kw_rank = 1").first().result]


def test_embed_from_table_weighted_mean(spark):
    wv = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vec array<double>")
    df = spark.createDataFrame([(1, "a a b zzz"), (2, "zzz")], "doc_id bigint, text string")
    got = {r.doc_id: r.embedding for r in emb.embed_from_table(df, wv).collect()}
    assert got[2] is None
    assert [round(x, 9) for x in got[1]] == [round(2 / 3, 9), round(1 / 3, 9)]


def test_finish_unwraps_and_converts(spark):
    df = spark.createDataFrame([([[0.1, 0.2]],)], "a array<array<double>>")
    r = df.select(emb.finish(F.col("a")).alias("f")).first().f
    assert len(r) == 2 and abs(r[0] - 0.1) < 1e-6


def test_finish_of_documents_without_an_embedding(spark):
    wv = spark.createDataFrame([("a", [0.1, 0.2])], "word string, vec array<double>")
    df = spark.createDataFrame([(1, "a"), (2, "?!"), (3, None), (4, "")], "doc_id bigint, text string")
    v = emb.embed_from_table(df, wv).select("doc_id", F.when(F.col("embedding").isNotNull(), F.array("embedding")).alias("a"))
    got = {r.doc_id: r for r in v.select("doc_id", emb.finish(F.col("a")).alias("f"), emb.finish(F.col("a"), True).alias("v")).collect()}
    assert [got[i].f for i in (2, 3, 4)] == [got[i].v for i in (2, 3, 4)] == [None] * 3
    assert [round(x, 6) for x in got[1].f] == [0.1, 0.2] == got[1].v.toArray().tolist()
    long = v.select("doc_id", F.posexplode(emb.finish(F.col("a"))).alias("dim", "value"))
    assert sorted((r.doc_id, r.dim) for r in long.collect()) == [(1, 0), (1, 1)]


def scores_by_hand(sentences, params, stop):
    """``(keyword, ln S, first sentence)`` of every candidate of one document, counted one by one."""
    edges = "".join(params.context_chars)
    tf: Counter = Counter()
    acronyms: Counter = Counter()
    capitals: Counter = Counter()
    places: dict[str, list[int]] = defaultdict(list)
    pairs: Counter = Counter()  # (term, next term)
    found: dict[tuple[str, ...], list[int]] = {}  # candidate: count, first sentence
    starts: dict[str, bool] = {}

    def ends_well(term: str) -> bool:
        ok = starts.get(term)
        if ok is None:
            ok = starts[term] = eligible(term) and term not in stop
        return ok

    def eligible(term: str) -> bool:
        return len(term) > 1 and not (term.isascii() and term.isdigit())

    low, high = params.min_ngrams, params.max_ngrams
    for at, sentence in enumerate(sentences):
        for chunk, part in enumerate(sentence.split(CHUNK_MARK)):
            part = part.strip(edges)
            if not part:
                continue
            words = part.split(" ")
            terms = part.lower().split(" ")
            for i, (word, term) in enumerate(zip(words, terms)):
                tf[term] += 1
                places[term].append(at)
                if word != term:
                    acronym, capital = kw._casing(word, chunk == 0 and i == 0)
                    acronyms[term] += acronym
                    capitals[term] += capital
            pairs.update(zip(terms, terms[1:]))
            for i, first in enumerate(terms):
                if not ends_well(first):
                    continue
                for n in range(low, min(high, len(terms) - i) + 1):
                    if n > 1 and not ends_well(terms[i + n - 1]) or n == 3 and not eligible(terms[i + 1]):
                        continue
                    seen = found.setdefault(tuple(terms[i:i + n]), [0, at])
                    seen[0] += 1
    if not found:
        return []
    left, right, left_n, right_n = Counter(), Counter(), Counter(), Counter()
    for (a, b), n in pairs.items():
        right[a] += 1
        right_n[a] += n
        left[b] += 1
        left_n[b] += n
    content = [n for t, n in tf.items() if t not in stop]
    mean = sum(content) / len(content) if content else 0.0
    deviation = math.sqrt(sum((n - mean) ** 2 for n in content) / len(content)) if content else 0.0
    top, total = max(tf.values()), len(sentences)
    scores: dict[str, float] = {}

    def score(term: str) -> float:
        s = scores.get(term)
        if s is None:
            n, own = tf[term], places[term]
            case = max(acronyms[term], capitals[term]) / (1.0 + math.log(n))
            position = math.log(math.log(3.0 + (own[(n - 1) // 2] + own[n // 2]) / 2))
            freq = n / (mean + deviation) if mean + deviation else 0.0
            sides = (left[term] / left_n[term] if left_n[term] else 0.0) + (right[term] / right_n[term] if right_n[term] else 0.0)
            rel = 1.0 + sides * n / top
            s = scores[term] = rel * position / (case + freq / rel + len(set(own)) / total / rel)
        return s

    out = []
    for words, (n, first) in found.items():
        middle = len(words) == 3 and words[1] in stop
        parts = [score(w) for w in (words[::2] if middle else words)]
        q = 1.0 - pairs[words[:2]] / tf[words[0]] * (pairs[words[1:]] / tf[words[1]]) if middle else 0.0
        ln = sum(map(math.log, parts)) + math.log(1.0 + q) - math.log(n) - math.log(1.0 + sum(parts) - q)
        out.append((" ".join(words), ln, first))
    return out


ODD_TEXTS = [TEXT, "", "...", "one", "the of and", "12 345 6", "NASA nasa Nasa NaSA", "(((a)))? b! c, d", "a b\n\n\nc d e",
             "same words same words. same words", "ÉCOLE École ΣΑΣ ΣΑΣ, İstanbul", "state of the art of state",
             "bread and butter. Bread and Butter and bread", "x1 x1 x1 y2 y2\tz3   x1", ", ".join("abcdefgh") + " ab cd ef",
             "Data engineers use Spark for ETL on NASA data. " * 3000]


@pytest.mark.parametrize("slice_chars", [1, 200, 1 << 20])
@pytest.mark.parametrize("params", [KeywordParams(), KeywordParams(2, 3, 3), KeywordParams(1, 1, 1), KeywordParams(3, 3, 7)])
def test_array_scores_equal_those_counted_one_by_one(spark, monkeypatch, slice_chars, params):
    monkeypatch.setattr(kw, "SLICE_CHARS", slice_chars)
    stop = frozenset(ENGLISH_STOP_WORDS)
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id bigint, text string")
    sentences = df.select("doc_id", kw._unbroken(F.col("text"), params.context_chars).alias("s")).orderBy("doc_id").toArrow().column("s").combine_chunks()
    got = []
    for part in kw._slices(sentences):
        where, ln, first, result = kw.keyword_scores(sentences[part.start:part.stop], params, stop)
        got += [(part.start + int(w), r, round(float(x), 8), int(f)) for w, x, f, r in zip(where, ln, first, result)]
    expected = []
    for at, some in enumerate(sentences.to_pylist()):
        best = heapq.nsmallest(params.num_keywords, scores_by_hand(some, params, stop), key=lambda c: (round(c[1], 9), c[0]))
        expected += [(at, r, round(x, 8), f) for r, x, f in best]
    assert got == expected


def test_scores_agree_with_the_tables_of_terms_and_candidates(spark):
    """T8 has array code of its own; T6 and T7 as DataFrames must give the same counts and term scores."""
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id bigint, text string").where("doc_id not in (10)")
    tokens = context_tokens(df)
    terms = {(r.doc_id, r.term): r for r in kw.term_features(tokens).collect()}
    candidates = {(r.doc_id, r.kw): r for r in kw.candidate_table(kw.keyword_events(tokens, KeywordParams())).collect()}
    rows = kw.extract_keywords(df, KeywordParams(num_keywords=100_000)).collect()
    assert {(r.doc_id, r.result) for r in rows} == set(candidates)
    for r in rows:
        found, words = candidates[r.doc_id, r.result], r.result.split(" ")
        assert r.sentence == found.sentence
        if len(words) < 3 or words[1] not in ENGLISH_STOP_WORDS:
            parts = [terms[r.doc_id, w].s_term for w in words]
            ln = sum(map(math.log, parts)) - math.log(found.tf_kw) - math.log(1 + sum(parts))
            assert abs(ln - r.ln_score) < 1e-9


def test_events_are_made_without_lambdas(spark):
    df = spark.createDataFrame([(1, "The NATO met. It met (again), Bob!"), (2, "x"), (3, None)], "doc_id bigint, text string")
    lambdas = [d._jdf.queryExecution().analyzed().toString().count("lambdafunction") for d in (
        context_tokens(df), kw.keyword_events(context_tokens(df), kw.KeywordParams()))]
    assert lambdas[0] == lambdas[1]
    events = kw.keyword_events(context_tokens(df), kw.KeywordParams())
    assert events.where("kind IS NULL OR key IS NULL").count() == 0
    seen = {(r.doc_id, r.key): (r.cnt, r.acr, r.cap) for r in events.where("kind = 'S'").collect() if r.key != "met"}
    assert seen == {(1, "the"): (1, 0, 0), (1, "nato"): (1, 1, 0), (1, "it"): (1, 0, 0), (1, "again"): (1, 0, 0),
                    (1, "bob"): (1, 0, 1), (2, "x"): (1, 0, 0)}
