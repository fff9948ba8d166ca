"""Parameters of the ingestion and search operators.

The defaults are the values the original system was configured with
(batch of 5000, sample of 50000, seed 42, YAKE n-grams 1..3 with 20 keywords,
k = 5 results from a 100-candidate budget, fusion penalties 61/60).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Characters split off token edges by the keyword tokenizer.
CONTEXT_CHARS = ("(", ")", "?", "!", ".", ",")


@dataclass(frozen=True)
class KeywordParams:
    min_ngrams: int = 1
    max_ngrams: int = 3
    num_keywords: int = 20
    context_chars: tuple[str, ...] = field(default=CONTEXT_CHARS)


@dataclass(frozen=True)
class EmbeddingParams:
    vector_size: int = 300
    vector_output: bool = False
    seed: int = 42


@dataclass(frozen=True)
class SearchParams:
    k: int = 5
    candidates: int = 100
    vector_penalty: int = 61
    keyword_penalty: int = 60
    bm25_k1: float = 1.2
    bm25_b: float = 0.75


@dataclass(frozen=True)
class IngestParams:
    batchsize: int = 5000
    samplesize: int = 50000
    seed: int = 42
    remainder: str = "none"  # "none" (observed behaviour) or "last" (intended)
