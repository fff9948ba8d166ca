"""YAKE keyword extraction as Spark jobs (T6 n-grams, T7 term features,
T8 scores + top-N, T9 nested column, L0 query keywords).

Per document, ``t`` = lower-cased term (Campos et al., Information Sciences
509, 2020), co-occurrence window 1:

    Case(t)   = max(TF_acronym, TF_capitalised_not_initial) / (1 + ln TF)
    Pos(t)    = ln(ln(3 + median(sentence index)))
    Freq(t)   = TF / (mean TF + population std TF)      over non-stop terms
    Rel(t)    = 1 + (DL + DR) * TF / max TF              max over all terms
    Spread(t) = distinct sentences with t / sentences in the document
    S(t)      = Rel * Pos / (Case + Freq / Rel + Spread / Rel)
    S(kw)     = prod S(t) / (TF(kw) * (1 + sum S(t)))    lower is better

DL (DR) = distinct left (right) neighbours / left (right) neighbour count,
0 without neighbours. Candidates have 1..3 terms, none pure-digit or one
character long, and neither start nor end with a stop word; an interior stop
word contributes ``1 + (1 - p)`` to the product and ``-(1 - p)`` to the sum,
``p = f(left, stop) * f(stop, right)`` with ``f(a, b) = count(a b) / TF(a)``.

Everything is computed in log space (``ln S(kw)``) because scores span many
orders of magnitude; ranking uses ``round(ln S, 9)`` then the keyword text.

Plan shape: T8 (``extract_keywords``) scores each document row by itself: its
sentences are split in the JVM; a slice of documents is counted and scored together
by array operations in Arrow batches, without a shuffle, join or checkpoint. T6 and T7 as tables of their own (``candidate_table``,
``term_features``) are DataFrame aggregates over a keyed event stream, shuffled by
(id, key).
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivesearch.config import KeywordParams
from archivesearch.functions import text as tx
from archivesearch.functions.stopwords import ENGLISH_STOP_WORDS, is_stop

RANK_DIGITS = 9


def _eligible(term: Column) -> Column:
    return (F.length(term) > 1) & ~term.rlike("^[0-9]+$")


def _acronym(word: Column) -> Column:
    return (F.length(word) > 1) & word.rlike(r"\p{Lu}") & ~word.rlike(r"\p{Ll}")


def _capitalised(word: Column, initial: Column) -> Column:
    return ~initial & word.rlike(r"^\p{Lu}") & ~_acronym(word)


def _event(kind: str, key: Column, sub: Column, si: Column, acr: Column, cap: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.alias("key"), sub.alias("sub"),
                    si.alias("si"), acr.alias("acr"), cap.alias("cap"))


def keyword_events(tokens: DataFrame, params: KeywordParams, id_col: str = "doc_id",
                   stop_words=ENGLISH_STOP_WORDS, with_candidates: bool = True, with_terms: bool = True) -> DataFrame:
    """All per-document counts in ONE partial + final hash aggregate, without a shuffle where
    the documents are dealt out by id (``tables.by_id``).

    Every token emits keyed events, aggregated by (id, kind, key, sub, si):
    ``S`` (term, sentence) with casing counts, ``L``/``R`` (term, left/right
    neighbour) — which are also the bigram counts — and ``C`` (candidate
    n-gram). Columns: id, kind, key, sub, si, cnt, acr, cap, first_sent, n_sent.
    """
    t1, r1, r2 = F.col("term"), F.col("rgt"), F.col("rgt2")
    sent = F.col("sent")
    zero, empty = F.lit(0), F.lit("")
    initial = (F.col("chunk") == 0) & (F.col("idx") == 0)
    ev = [
        _event("S", t1, empty, sent, F.col("acr"), F.col("cap")),
        F.when(F.col("lft").isNotNull(), _event("L", t1, F.col("lft"), zero, zero, zero)),
        F.when(r1.isNotNull(), _event("R", t1, r1, zero, zero, zero)),
    ] if with_terms else []
    if with_candidates:
        ok1 = _eligible(t1) & ~is_stop(t1, stop_words)
        if params.min_ngrams <= 1 <= params.max_ngrams:
            ev.append(F.when(ok1, _event("C", t1, empty, zero, zero, zero)))
        if params.min_ngrams <= 2 <= params.max_ngrams:
            ok2 = ok1 & r1.isNotNull() & _eligible(r1) & ~is_stop(r1, stop_words)
            ev.append(F.when(ok2, _event("C", F.concat_ws(" ", t1, r1), empty, zero, zero, zero)))
        if params.min_ngrams <= 3 <= params.max_ngrams:
            ok3 = (ok1 & r1.isNotNull() & r2.isNotNull() & _eligible(r1) & _eligible(r2)
                   & ~is_stop(r2, stop_words))
            ev.append(F.when(ok3, _event("C", F.concat_ws(" ", t1, r1, r2), empty, zero, zero, zero)))
    if with_terms:  # once for each token, before it becomes events
        tokens = tokens.select("*", _acronym(F.col("word")).cast("int").alias("acr"),
                               _capitalised(F.col("word"), initial).cast("int").alias("cap"))
    # what is no event leaves after the explode: a lambda would be run apart from the generated code
    events = (tokens.select(id_col, "n_sent", "sent", F.explode(F.array(*ev)).alias("e"))
              .where("e IS NOT NULL").select(id_col, "n_sent", "sent", "e.*"))
    return events.groupBy(id_col, "kind", "key", "sub", "si").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("acr").alias("acr"), F.sum("cap").alias("cap"),
        F.min("sent").alias("first_sent"), F.max("n_sent").alias("n_sent"))


def term_table(events: DataFrame, id_col: str = "doc_id", stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """One row per (id, term) with TF, features and S(t)."""
    k = F.col("kind")
    is_s, is_l, is_r = k == "S", k == "L", k == "R"
    terms = (events.where(k.isin("S", "L", "R"))
             .groupBy(id_col, F.col("key").alias("term")).agg(
                 F.sum(F.when(is_s, F.col("cnt"))).alias("tf"),
                 F.sum(F.when(is_s, F.col("acr"))).alias("tf_acr"),
                 F.sum(F.when(is_s, F.col("cap"))).alias("tf_cap"),
                 F.percentile(F.when(is_s, F.col("si")), F.lit(0.5), F.col("cnt")).alias("med_sent"),
                 F.count_if(is_s).alias("n_sent_t"),
                 F.count_if(is_l).alias("dl_n"), F.sum(F.when(is_l, F.col("cnt"))).alias("dl_d"),
                 F.count_if(is_r).alias("dr_n"), F.sum(F.when(is_r, F.col("cnt"))).alias("dr_d"),
                 F.max("n_sent").alias("n_sent"))
             .withColumn("is_stop", is_stop(F.col("term"), stop_words)))
    w = Window.partitionBy(id_col)
    content_tf = F.when(~F.col("is_stop"), F.col("tf"))
    terms = (terms
             .withColumn("mean_tf", F.avg(content_tf).over(w))
             .withColumn("std_tf", F.stddev_pop(content_tf).over(w))
             .withColumn("max_tf", F.max("tf").over(w)))
    tf = F.col("tf").cast("double")
    case_ = F.greatest("tf_acr", "tf_cap") / (F.lit(1.0) + F.ln(tf))
    pos_ = F.ln(F.ln(F.lit(3.0) + F.col("med_sent")))
    freq = tf / F.nullif(F.col("mean_tf") + F.coalesce(F.col("std_tf"), F.lit(0.0)), F.lit(0.0))
    dl = F.coalesce(F.col("dl_n") / F.nullif(F.col("dl_d"), F.lit(0)), F.lit(0.0))
    dr = F.coalesce(F.col("dr_n") / F.nullif(F.col("dr_d"), F.lit(0)), F.lit(0.0))
    rel = F.lit(1.0) + (dl + dr) * tf / F.col("max_tf")
    spread = F.col("n_sent_t") / F.col("n_sent")
    s = rel * pos_ / (case_ + F.coalesce(freq, F.lit(0.0)) / rel + spread / rel)
    return terms.select(
        id_col, "term", "tf", "is_stop",
        case_.alias("f_case"), pos_.alias("f_pos"), freq.alias("f_freq"),
        rel.alias("f_rel"), spread.alias("f_spread"), s.alias("s_term"))


def term_features(tokens: DataFrame, id_col: str = "doc_id", stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    ev = keyword_events(tokens, KeywordParams(), id_col, stop_words, with_candidates=False)
    return term_table(ev, id_col, stop_words)


def candidate_table(events: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per (id, candidate) with its count and first sentence."""
    c = events.where(F.col("kind") == "C")
    return c.select(id_col, F.col("key").alias("kw"), F.size(F.split("key", " ")).alias("n"),
                    F.col("cnt").alias("tf_kw"), F.col("first_sent").alias("sentence"))


def _unbroken(text: Column, context_chars) -> Column:
    """Sentences of a text, each a string of its chunks (see ``tx.context_tokens``)."""
    ctx = tx.context_class(context_chars)
    return F.transform(tx.sentence_array(text), lambda s: F.regexp_replace(
        F.regexp_replace(F.regexp_replace(s, r"^\s+|\s+$", ""), r"\s+", " "), f"(?<={ctx}) | (?={ctx})", tx.CHUNK_MARK))


def _casing(word: str, initial: bool) -> tuple[bool, bool]:
    """(acronym, capitalised but not sentence-initial)."""
    if word == word.lower():
        return False, False
    kinds = [unicodedata.category(c) for c in word]
    acronym = len(word) > 1 and "Lu" in kinds and "Ll" not in kinds
    return acronym, kinds[0] == "Lu" and not acronym and not initial


#: Characters of documents that are scored together; a longer document is scored alone.
SLICE_CHARS = 1 << 20


def _tokens(sentences: pa.ListArray, context_chars) -> dict[str, np.ndarray | pa.Array]:
    """Tokens of all documents in order: place of the document, its sentence, the chunk (numbered over all documents),
    word code, whether it opens a sentence; and the distinct words."""
    per_doc = pc.list_value_length(sentences).to_numpy(zero_copy_only=False).astype(np.int64)
    doc_of = np.repeat(np.arange(len(per_doc)), per_doc)
    number = np.arange(len(doc_of)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    chunks = pc.split_pattern(sentences.flatten(), tx.CHUNK_MARK)
    per_sentence = pc.list_value_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64)
    sentence_of = np.repeat(np.arange(len(per_sentence)), per_sentence)
    opens = np.zeros(len(sentence_of), dtype=bool)
    opens[(np.cumsum(per_sentence) - per_sentence)[per_sentence > 0]] = True
    words = pc.split_pattern(pc.utf8_trim(chunks.flatten(), characters="".join(context_chars)), " ")
    per_chunk = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    chunk = np.repeat(np.arange(len(per_chunk)), per_chunk)
    first = np.zeros(len(chunk), dtype=bool)
    first[(np.cumsum(per_chunk) - per_chunk)[per_chunk > 0]] = True
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    some = np.flatnonzero(pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[code]) if len(code) else np.empty(0, np.int64)
    chunk = chunk[some]
    sentence = sentence_of[chunk]
    return {"doc": doc_of[sentence], "sentence": number[sentence], "chunk": chunk, "code": code[some],
            "initial": first[some] & opens[chunk], "per_doc": per_doc, "words": coded.dictionary.to_pylist()}


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each distinct key, each place's key as a dense number in order of the keys, and their counts."""
    _, first, which, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return first, which, count


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b != 0)


def keyword_scores(sentences: pa.ListArray, params: KeywordParams, stop: frozenset[str],
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """The ``num_keywords`` best candidates of each document in order of rank: the document's place, ln S, first sentence, text.

    Terms are numbers: a document's terms, pairs of neighbours and candidates are counted for all documents
    at once by sorting their numbers, and every formula is one array expression."""
    none = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), []
    t = _tokens(sentences, params.context_chars)
    doc, sentence, chunk = t["doc"], t["sentence"], t["chunk"]
    if not len(doc):
        return none
    terms: dict[str, int] = {}
    term_of_word = np.array([terms.setdefault(w.lower(), len(terms)) for w in t["words"]])
    casing = np.array([_casing(w, False) for w in t["words"]])
    texts = list(terms)
    is_stop_term = np.array([x in stop for x in texts])
    eligible = np.array([len(x) > 1 and not (x.isascii() and x.isdigit()) for x in texts])
    term = term_of_word[t["code"]]

    # terms of a document: tf, casing, sentences
    first, own, tf = _grouped(doc * len(texts) + term)
    size = len(tf)
    own_doc, own_stop = doc[first], is_stop_term[term[first]]
    acronyms = np.bincount(own, weights=casing[t["code"], 0], minlength=size)
    capitals = np.bincount(own, weights=casing[t["code"], 1] & ~t["initial"], minlength=size)
    order = np.argsort(own, kind="stable")
    at = np.cumsum(tf) - tf
    places = sentence[order]
    middle = (places[at + (tf - 1) // 2] + places[at + tf // 2]) / 2
    turns = np.append(True, (own[order][1:] != own[order][:-1]) | (places[1:] != places[:-1]))
    spread = np.bincount(own[order][turns], minlength=size)

    # pairs of neighbours in a chunk
    beside = np.flatnonzero(chunk[1:] == chunk[:-1])
    pair_first, pair, pair_n = _grouped(own[beside] * size + own[beside + 1])
    left, right = own[beside + 1][pair_first], own[beside][pair_first]  # the terms that have it on their left, right
    side = [_ratio(np.bincount(x, minlength=size), np.bincount(x, weights=pair_n, minlength=size)) for x in (left, right)]

    # features and S(t)
    documents = len(t["per_doc"])
    content = ~own_stop
    rows = np.bincount(own_doc[content], minlength=documents)
    mean = _ratio(np.bincount(own_doc[content], weights=tf[content], minlength=documents), rows)
    spare = (tf - mean[own_doc])[content] ** 2
    usual = mean + np.sqrt(_ratio(np.bincount(own_doc[content], weights=spare, minlength=documents), rows))
    top = np.zeros(documents)
    np.maximum.at(top, own_doc, tf)
    case = np.maximum(acronyms, capitals) / (1.0 + np.log(tf))
    rel = 1.0 + (side[0] + side[1]) * tf / top[own_doc]
    s = rel * np.log(np.log(3.0 + middle)) / (
        case + _ratio(tf, usual[own_doc]) / rel + spread / t["per_doc"][own_doc] / rel)

    # candidates: runs of 1..n terms that end well on both sides
    well = eligible[term] & ~is_stop_term[term]
    pair_at = np.full(len(term), -1)
    pair_at[beside] = pair
    found = []
    key = own
    for n in range(1, min(params.max_ngrams, len(term)) + 1):
        last = np.arange(n - 1, len(term))
        if n > 1:
            _, key, _ = _grouped(key[:len(last)] * size + own[last])
        if n < params.min_ngrams:
            continue
        ok = well[:len(last)] & well[last] & (chunk[:len(last)] == chunk[last])
        if n == 3:
            ok &= eligible[term[1:-1]]
        starts = np.flatnonzero(ok)
        if not len(starts):
            continue
        begin, _, count = _grouped(key[starts])
        begin = starts[begin]
        parts = s[own[begin[:, None] + np.arange(n)]]
        q = np.zeros(len(begin))
        if n == 3:
            inner = is_stop_term[term[begin + 1]]
            a, b = begin[inner], begin[inner] + 1
            q[inner] = 1.0 - pair_n[pair_at[a]] / tf[own[a]] * (pair_n[pair_at[b]] / tf[own[b]])
            logs, sums = np.log(parts), parts.copy()
            logs[inner, 1] = sums[inner, 1] = 0.0
        else:
            logs, sums = np.log(parts), parts
        ln = logs.sum(axis=1) + np.log(1.0 + q) - np.log(count) - np.log(1.0 + sums.sum(axis=1) - q)
        found.append((begin, np.full(len(begin), n), ln))
    if not found:
        return none
    begin, n, ln = (np.concatenate(c) for c in zip(*found))

    # the best of each document; those that tie with the last one are ordered by their text
    rounded, where = np.round(ln, RANK_DIGITS), doc[begin]
    order = np.lexsort((rounded, where))
    begin, n, ln, rounded, where = (c[order] for c in (begin, n, ln, rounded, where))
    opening = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    length = np.diff(np.append(opening, len(where)))
    limit = rounded[opening + np.minimum(length, params.num_keywords) - 1]
    some = np.flatnonzero(rounded <= np.repeat(limit, length))
    names = [" ".join(texts[x] for x in term[b:b + k].tolist()) for b, k in zip(begin[some].tolist(), n[some].tolist())]
    keys = list(zip(where[some].tolist(), rounded[some].tolist(), names))
    best, seen = [], Counter()
    for j in sorted(range(len(keys)), key=keys.__getitem__):
        seen[keys[j][0]] += 1
        if seen[keys[j][0]] <= params.num_keywords:
            best.append(j)
    some = some[best]
    return where[some], ln[some], sentence[begin[some]], [names[j] for j in best]


def _slices(sentences: pa.ListArray) -> Iterator[slice]:
    """Runs of documents of about :data:`SLICE_CHARS` bytes."""
    upto = np.append(0, np.cumsum(pc.binary_length(sentences.flatten()).to_numpy(zero_copy_only=False)))
    ends = upto[np.append(0, np.cumsum(pc.list_value_length(sentences).to_numpy(zero_copy_only=False))).astype(np.int64)]
    at = 0
    while at < len(sentences):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_CHARS, side="right")) - 1)
        yield slice(at, to)
        at = to


def extract_keywords(df: DataFrame, params: KeywordParams = KeywordParams(), *,
                     id_col: str = "doc_id", text_col: str = "text",
                     stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """Long keyword table (id, result, score, ln_score, sentence, kw_rank), the best
    ``num_keywords`` of each row by (round(ln S, 9), result).

    A document's score needs nothing of another document: sentences are split in the
    JVM and scored in Arrow batches, with no shuffle or join.
    """
    stop = frozenset(stop_words)
    texts = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col), _unbroken(F.col(text_col), params.context_chars).alias("sentences"))
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL(
        "result string, score double, ln_score double, sentence int, kw_rank bigint").fields])

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sentences = batch.columns
            for part in _slices(sentences):
                where, ln, first, result = keyword_scores(sentences[part.start:part.stop], params, stop)
                opening = np.searchsorted(where, where)
                columns = (pa.array(result, pa.string()), pa.array(np.exp(ln)), pa.array(ln), pa.array(first.astype(np.int32)),
                           pa.array(np.arange(len(where)) - opening + 1))
                yield pa.RecordBatch.from_arrays([ids[part.start:part.stop].take(pa.array(where)), *columns], names=schema.names)

    return texts.mapInArrow(score_rows, schema)


def nest_keywords(df: DataFrame, keywords: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Attach ``keywords ARRAY<STRUCT<result, score, sentence>>`` ordered by
    rank; documents without any keyword keep a NULL column (left join)."""
    nested = keywords.groupBy(id_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("kw_rank", "result", "score", "sentence"))),
                    lambda x: F.struct(x["result"].alias("result"), x["score"].alias("score"),
                                       x["sentence"].cast("int").alias("sentence"))).alias("keywords"))
    return df.join(nested, id_col, "left")


def query_keywords(queries: DataFrame, params: KeywordParams = KeywordParams(),
                   stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """L0: the same extraction over query texts -> (query_id, result)."""
    kw = extract_keywords(queries, params, id_col="query_id", text_col="text", stop_words=stop_words)
    return kw.select("query_id", "result", "kw_rank")
