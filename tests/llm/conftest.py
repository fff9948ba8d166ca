from __future__ import annotations

import os
import random
import string
import uuid

import pytest


@pytest.fixture
def table(spark, tmp_path):
    """Writes rows as Parquet and reads them back, as operators meet them."""

    def make(rows, schema="doc_id bigint, text string", files=2):
        path = str(tmp_path / uuid.uuid4().hex)
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return make


@pytest.fixture
def words():
    """``words(n, seed)``: n invented words."""

    def make(n, seed):
        rng = random.Random(seed)
        return ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 8))) for _ in range(n)]

    return make
