"""archivesearch: Spark-native ingestion and hybrid search over news archives.

Every public operator takes and returns DataFrames; nothing is collected to
the driver in the core path. Sub-packages:

- ``sources``   archive listing/extraction, XML records, sinks
- ``functions`` column-expression helpers (text cleaning, highlighting, scores)
- ``operators`` keyword extraction, embeddings, lexical/vector search, fusion
- ``plans``     registered queries and their SQL equivalents
- ``streaming`` incremental ingestion with Structured Streaming
"""

from archivesearch.config import IngestParams, KeywordParams, SearchParams

__all__ = ["IngestParams", "KeywordParams", "SearchParams"]
