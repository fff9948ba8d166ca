"""The English stop-word list used for keyword extraction and query cleaning.

It is the default English list of Spark ML's ``StopWordsRemover``
(``loadDefaultStopWords("english")``), written out so SQL oracles can use the
same literal without a running JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark ML default English stop words (181 entries, original order).
ENGLISH_STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "her",
    "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where",
    "why", "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's",
    "what's", "when's", "where's", "who's", "why's", "would",
)


def stop_array(words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> Column:
    """The stop words as an array literal (constant-folded into each task)."""
    return F.array(*[F.lit(w) for w in words])


def is_stop(term: Column, words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> Column:
    """``term IN (...)``: an ``InSet`` hash lookup, evaluated in codegen."""
    return term.isin(list(words))


def sql_list(words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> str:
    """The words as a SQL list body: ``'i', 'me', ...`` (quotes doubled)."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
