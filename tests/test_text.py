"""Text functions on tiny literal frames."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from archivesearch.functions import text as tx


def one(spark, col_expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ",".join(f"{k} string" for k in values))
    return df.select(col_expr.alias("r")).first()["r"]


def test_clean_query_drops_stop_words_digits_accents(spark):
    r = one(spark, tx.clean_query(F.col("q")), q="  The Café costs 42 dollars, and THE tax!  ")
    assert r == "caf costs dollars tax"


def test_clean_query_only_stop_words_is_empty(spark):
    assert one(spark, tx.clean_query(F.col("q")), q="the and of it") == ""


def test_clean_text(spark):
    assert one(spark, tx.clean_text(F.col("t")), t="  héllo,  wörld--42 ") == "h llo w rld 42"


def test_highlight_all_matches_case_insensitive(spark):
    r = one(spark, tx.highlight(F.col("t"), F.col("re"), open_tag="[", close_tag="]"),
            t="Cat scatter CAT", re="cat|dog")
    assert r == "[Cat] s[cat]ter [CAT]"


def test_highlight_empty_regex_returns_text(spark):
    assert one(spark, tx.highlight(F.col("t"), F.col("re")), t="abc", re="") == "abc"


def test_highlight_tags_stripped_returns_input(spark):
    text = "alpha beta Gamma delta beta epsilon " * 20
    r = one(spark, tx.highlight(F.col("t"), F.col("re")), t=text, re="beta|gamma")
    assert r.replace(tx.HIGHLIGHT_OPEN, "").replace(tx.HIGHLIGHT_CLOSE, "") == text


def _py_snippet(text, regex, ctx=200):
    m = re.search(regex, text, re.IGNORECASE)
    if not m:
        return text[:ctx]
    s, e = m.span()
    cs, ce = max(0, s - ctx), min(len(text), e + ctx)
    block = text[cs:ce]
    return re.sub(f"({regex})", lambda g: "[" + g.group(1) + "]", block, flags=re.IGNORECASE)


def test_snippet_matches_python_semantics(spark):
    text = ("x" * 300) + " Needle here " + ("y" * 300) + " needle again"
    r = one(spark, tx.snippet(F.col("t"), F.col("re"), open_tag="[", close_tag="]"), t=text, re="needle")
    assert r == _py_snippet(text, "needle")


def test_snippet_no_match_gives_prefix(spark):
    text = "z" * 500
    assert one(spark, tx.snippet(F.col("t"), F.col("re")), t=text, re="needle") == "z" * 200


def test_sentences_and_context_tokens(spark):
    df = spark.createDataFrame([(1, "( Hello big,world. x  (y z) ...\nNext LINE here!")],
                               "doc_id bigint, text string")
    sents = [r["sentence"] for r in tx.sentences(df).orderBy("sent").collect()]
    assert sents == ["( Hello big,world.", "x  (y z) ...", "Next LINE here!"]
    toks = tx.context_tokens(df).orderBy("sent", "chunk", "idx").collect()
    got = [(r.sent, r.chunk, r.idx, r.term, r.lft, r.rgt) for r in toks]
    assert got == [
        (0, 1, 0, "hello", None, "big,world"),
        (0, 1, 1, "big,world", "hello", None),
        (1, 0, 0, "x", None, None),
        (1, 1, 0, "y", None, "z"),
        (1, 1, 1, "z", "y", None),
        (2, 0, 0, "next", None, "line"),
        (2, 0, 1, "line", "next", "here"),
        (2, 0, 2, "here", "line", None),
    ]


def test_plain_tokens_unicode(spark):
    df = spark.createDataFrame([(1, "Ça va? Très-bien, 42x")], "doc_id bigint, text string")
    assert [r.token for r in tx.plain_tokens(df).orderBy("pos").collect()] == ["ça", "va", "très", "bien", "42x"]
