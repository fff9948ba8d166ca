"""Document embeddings: mean of given word vectors (E1), trained Word2Vec
(E2), the finisher that unwraps/converts the result (E3) and the composed
annotation stage (E4 lives in ``operators.annotate``).

E1 plan: documents are dealt by id into slices of a bounded number of bytes. The
distinct words of each slice meet the word-vector table in a join on the word, and
their vectors come back to the slice, where the means are array operations. So a word
crosses a shuffle once for each slice that holds it, not once for each document, and
no table of vectors is held whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivesearch.config import EmbeddingParams
from archivesearch.functions import text as tx

HEX = "0123456789abcdef"


def hashed_word_vectors(words: DataFrame, dim: int = 16, word_col: str = "word") -> DataFrame:
    """A deterministic word-vector table: component i of ``w`` is built from
    two hex digits of md5(w) (so ``dim <= 16``): sqrt((16*h1 + h2) / 255) - 0.5.
    (sqrt is correctly rounded everywhere, and its means avoid exact decimal
    halves, so other engines reproduce the rounded values.)"""
    if not 1 <= dim <= 16:
        raise ValueError("dim must be in 1..16")
    h = F.md5(F.col(word_col))

    def digit(pos: Column) -> Column:
        return F.instr(F.lit(HEX), F.substring(h, pos, F.lit(1))) - 1

    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                      lambda i: F.sqrt((digit(i * 2 + 1) * 16 + digit(i * 2 + 2)).cast("double") / 255.0) - 0.5)
    return words.select(F.col(word_col).alias("word"), vec.alias("vec"))


#: Bytes of texts that meet their words' vectors in one group.
SLICE_BYTES = 4 << 20


def _means(texts: pa.Table, words: pa.Table) -> pa.Table:
    """``(id, embedding)`` of each row of ``texts(id, tokens)``: the mean vector of the tokens that all rows of its id have
    in ``words(word, vec)``; null for a null id and without a known token."""
    ids, tokens = (texts.column(c).combine_chunks() for c in ("id", "tokens"))
    which = ids.dictionary_encode().indices  # null for a null id
    own = which.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    n = int(own.max(initial=-1)) + 1
    vectors = words.column("vec").combine_chunks()
    dim = len(vectors.flatten()) // max(len(vectors), 1)
    total, count = np.zeros((n, dim)), np.zeros(n)
    if len(words):
        coded = words.column("word").combine_chunks().dictionary_encode()
        rows = coded.indices.to_numpy(zero_copy_only=False)
        given = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        vec = np.zeros((len(coded.dictionary), dim), given.dtype if len(coded.dictionary) == len(rows) else float)
        np.add.at(vec, rows, given)
        times = np.bincount(rows, minlength=len(vec))  # of a word that the table has more than once
        code = pc.index_in(tokens.flatten(), coded.dictionary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(own, pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False))
        known = (code >= 0) & (doc >= 0)
        key, many = np.unique(doc[known] * len(vec) + code[known], return_counts=True)
        doc, code = np.divmod(key, len(vec))
        step = max(1, (1 << 21) // max(dim, 1))
        for at in range(0, len(key), step):
            part = slice(at, at + step)
            some, start = np.unique(doc[part], return_index=True)
            total[some] += np.add.reduceat(vec[code[part]] * many[part, None], start, axis=0)
            count[some] += np.add.reduceat(times[code[part]] * many[part], start)
    found = np.append(count, 0)[own] > 0
    mean = total[own[found]] / count[own[found], None]
    ends = np.append(0, np.cumsum(found)) * dim
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(mean.ravel()), mask=pa.array(~found))
    return pa.table([ids, lists], names=["id", "embedding"])


def embed_from_table(df: DataFrame, word_vectors: DataFrame, *, id_col: str = "doc_id",
                     text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, embedding ARRAY<DOUBLE>) = count-weighted mean of the vectors of
    the document's known tokens; NULL when no token is known."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    slices = max(1, math.ceil(size / slice_bytes))
    tasks = max(slices, df.sparkSession.sparkContext.defaultParallelism)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      # null ids need not meet
                      F.pmod(F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col))), F.lit(slices)).alias("slice"),
                      ).repartition(tasks, "slice").select(
        "id", "slice", tx.plain_token_array(F.col("text")).alias("tokens"))
    words = texts.select(F.col("slice").alias("of"), F.explode("tokens").alias("word")).distinct()
    kind = word_vectors.schema["vec"].dataType  # floats are sent as such, means are of doubles
    vec = F.col("vec") if kind == T.ArrayType(T.FloatType(), kind.containsNull) else F.col("vec").cast("array<double>").alias("vec")
    known = words.join(word_vectors.select("word", vec), "word").select("of", "word", "vec")
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    return texts.groupBy("slice").cogroup(known.repartition(tasks, "of").groupBy("of")).applyInArrow(
        _means, schema).withColumnRenamed("id", id_col)


def train_word_vectors(df: DataFrame, params: EmbeddingParams = EmbeddingParams(), *, text_col: str = "text",
                       max_iter: int = 1, min_count: int = 5, num_partitions: int | None = None):
    """A Word2Vec model of the documents' tokens. Words seen less than ``min_count`` times
    are left out of the vocabulary, which MLlib holds on the driver; training is split over
    ``num_partitions`` (as many as the session's parallelism unless given)."""
    from pyspark.ml.feature import Word2Vec

    parts = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    toks = df.select(tx.plain_token_array(F.col(text_col)).alias("tokens"))
    return Word2Vec(vectorSize=params.vector_size, seed=params.seed, minCount=min_count, maxIter=max_iter,
                    numPartitions=parts, inputCol="tokens", outputCol="v").fit(toks)


def embed_with_model(df: DataFrame, model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, embedding): mean of the model's word vectors. The same model serves later batches and
    queries, so their vectors compare."""
    toks = df.select(id_col, tx.plain_token_array(F.col(text_col)).alias("tokens"))
    return model.transform(toks).select(id_col, vector_to_array("v").alias("embedding"))


def embed_trained(df: DataFrame, params: EmbeddingParams = EmbeddingParams(), *, id_col: str = "doc_id",
                  text_col: str = "text", max_iter: int = 1, min_count: int = 5):
    """``(vectors, model)`` of a model trained on these documents."""
    model = train_word_vectors(df, params, text_col=text_col, max_iter=max_iter, min_count=min_count)
    return embed_with_model(df, model, id_col=id_col, text_col=text_col), model


def finish(annotation: Column, as_vector: bool = False) -> Column:
    """Unwrap ``[[...]]`` (first element) and emit float32 array or ML vector; null where there is none, which
    ``array_to_vector`` itself does not take."""
    inner = F.when(F.size(annotation) > 0, F.element_at(annotation, 1))
    vector = array_to_vector(inner)
    return F.when(inner.isNotNull(), vector if as_vector else vector_to_array(vector, "float32"))
