"""Text column expressions: sentence split (T2), tokenisers (T3, T4),
query/text cleaning (P1, P2), match regex (P3), highlighting (P4) and
snippets (P5). All are built-in Spark SQL functions (JVM side); the array
steps use higher-order functions so no row leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivesearch.config import CONTEXT_CHARS
from archivesearch.functions.stopwords import ENGLISH_STOP_WORDS, is_stop

SENT_MARK = "\u0001"

# The highlight markup of the original result view.
HIGHLIGHT_OPEN = "<span style='background-color: yellow;'>"
HIGHLIGHT_CLOSE = "</span>"
SNIPPET_CONTEXT = 200


def context_class(chars=CONTEXT_CHARS) -> str:
    return "[" + "".join(re.escape(c) if c in "]\\^-" else c for c in chars) + "]"


# ------------------------------------------------------------ T2 sentences

def sentence_array(text: Column) -> Column:
    """Sentences of ``text``: break after ``.!?`` followed by whitespace and at
    every newline; blank pieces are dropped (so indexes are dense)."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1" + SENT_MARK)
    pieces = F.split(marked, "[" + SENT_MARK + r"\n]")
    return F.filter(pieces, lambda s: s.rlike(r"\S"))


def sentences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sent, sentence) with ``sent`` 0-based."""
    return df.select(id_col, F.posexplode(sentence_array(F.col(text_col))).alias("sent", "sentence"))


# ------------------------------------------------------------ T3 tokens

CHUNK_MARK = "\u0002"


def context_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   context_chars=CONTEXT_CHARS) -> DataFrame:
    """Keyword tokeniser: one row per token with its in-chunk neighbours.

    Tokens are whitespace-separated inside each sentence; context characters
    are stripped from token edges. A context character at a token edge
    breaks the sentence there, so each sentence is split into unbroken
    *chunks* (a token made only of context characters is its own, empty,
    chunk and emits no row). ``lft``/``rgt``/``rgt2`` are the lower-case
    neighbour terms within the chunk (NULL at its ends).

    Columns: id, n_sent, sent, chunk, idx (position in chunk), word
    (original case), term (lower case), lft, rgt, rgt2. A token is
    sentence-initial iff chunk = 0 and idx = 0.

    Built from whole-string regexes, ``split`` and ``arrays_zip`` of shifted
    arrays: no per-element lambdas, no window, no shuffle.
    """
    ctx = context_class(context_chars)
    sents = df.select(id_col, sentence_array(F.col(text_col)).alias("_sa"))
    s = sents.select(id_col, F.size("_sa").alias("n_sent"),
                     F.posexplode("_sa").alias("sent", "sentence"))
    norm = F.regexp_replace(F.regexp_replace(F.col("sentence"), r"^\s+|\s+$", ""), r"\s+", " ")
    marked = F.regexp_replace(norm, f"(?<={ctx}) | (?={ctx})", CHUNK_MARK)
    c = s.select(id_col, "n_sent", "sent", F.posexplode(F.split(marked, CHUNK_MARK)).alias("chunk", "ctext"))
    words = F.regexp_replace(F.col("ctext"), f"^{ctx}+|{ctx}+$", "")
    c = c.select(id_col, "n_sent", "sent", "chunk", F.split(words, " ").alias("w"),
                 F.split(F.lower(words), " ").alias("lw"))
    n = F.size("w")
    z = F.arrays_zip(F.col("w").alias("word"), F.col("lw").alias("term"),
                     F.slice("lw", 2, n).alias("rgt"), F.slice("lw", 3, n).alias("rgt2"),
                     F.slice(F.concat(F.array(F.lit(None).cast("string")), F.col("lw")), 1, n).alias("lft"),
                     F.sequence(F.lit(0), n - 1).alias("idx"))
    out = (c.select(id_col, "n_sent", "sent", "chunk", F.explode(z).alias("t"))
           .select(id_col, "n_sent", "sent", "chunk", "t.idx", "t.word", "t.term", "t.lft", "t.rgt", "t.rgt2")
           .where(F.col("word") != ""))
    return out


# ------------------------------------------------------------ T4 tokens

def plain_token_array(text: Column) -> Column:
    """Lower-cased letter/digit runs (embedding tokeniser)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def plain_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(id_col, F.posexplode(plain_token_array(F.col(text_col))).alias("pos", "token"))


# ------------------------------------------------------------ T5 stop words

def remove_stop_words(tokens: Column, words=ENGLISH_STOP_WORDS) -> Column:
    return F.filter(tokens, lambda w: ~is_stop(w, words))


# ------------------------------------------------------------ P1 - P5

def clean_query(q: Column, words=ENGLISH_STOP_WORDS) -> Column:
    """trim, lower, non a-z -> space, split, drop stop words, re-join."""
    letters = F.trim(F.regexp_replace(F.lower(q), "[^a-z]+", " "))
    kept = F.filter(F.split(letters, " "), lambda w: (w != "") & ~is_stop(w, words))
    return F.array_join(kept, " ")


def clean_text(text: Column) -> Column:
    """Characters outside 0-9a-zA-Z become one space; trimmed."""
    return F.trim(F.regexp_replace(text, "[^0-9a-zA-Z]+", " "))


def query_regex(cleaned: Column) -> Column:
    """Alternation of the cleaned query words (substring matches)."""
    return F.regexp_replace(cleaned, " ", "|")


def _ci(regex: Column) -> Column:
    return F.concat(F.lit("(?i)("), regex, F.lit(")"))


def highlight(text: Column, regex: Column, chunk_start: Column | None = None,
              chunk_end: Column | None = None, open_tag: str = HIGHLIGHT_OPEN,
              close_tag: str = HIGHLIGHT_CLOSE) -> Column:
    """Wrap every case-insensitive match of ``regex`` in ``[chunk_start, chunk_end)``
    (0-based; NULL/0 means the whole text). An empty regex returns the block."""
    start = F.coalesce(chunk_start, F.lit(0)) if chunk_start is not None else F.lit(0)
    end = (F.when(F.coalesce(chunk_end, F.lit(0)) == 0, F.length(text)).otherwise(chunk_end)
           if chunk_end is not None else F.length(text))
    block = F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))
    marked = F.regexp_replace(block, _ci(regex), F.lit(open_tag + "$1" + close_tag))
    return F.when(F.coalesce(regex, F.lit("")) == "", block).otherwise(marked)


def snippet(text: Column, regex: Column, ctx_length: int = SNIPPET_CONTEXT,
            open_tag: str = HIGHLIGHT_OPEN, close_tag: str = HIGHLIGHT_CLOSE) -> Column:
    """First match +- ``ctx_length`` characters, clamped, highlighted; without
    a match the first ``ctx_length`` characters."""
    pat = _ci(regex)
    pos1 = F.regexp_instr(text, pat)  # 1-based, 0 = no match
    mlen = F.coalesce(F.length(F.regexp_substr(text, pat)), F.lit(0))
    start0 = pos1 - 1
    c_start = F.greatest(start0 - ctx_length, F.lit(0))
    c_end = F.least(start0 + mlen + ctx_length, F.length(text))
    has = (F.coalesce(regex, F.lit("")) != "") & (pos1 > 0)
    return F.when(has, highlight(text, regex, c_start, c_end, open_tag, close_tag)) \
            .otherwise(F.substring(text, 1, ctx_length))
