from __future__ import annotations

import math
import random
import struct
import tracemalloc
import zlib

import pyarrow as pa
import pytest

from archivesearch.llm.packing import best_fit, cut_pieces, encode_texts, pack, tokenised_pieces
from archivesearch.llm.queries import tokenizer_path


def check(placed, capacity):
    by = {}
    for r in placed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_word_by_word_ids_equal_whole_text_ids():
    from tokenizers import Tokenizer

    rng = random.Random(4)
    parts = ["Hello", "I\u0307", "É́té", "don't", "x'll", "<|endoftext|>", "日本語", "́", "12,345", " ", " ",
             "…", "ß", "İ", "a\x1cb", "\x85", " ", "\n", "\t ", "\x0b", "😀👩‍👩‍👧", "--", "<|startoftext|>x"]
    texts = ["".join(rng.choices(parts, k=30)) for _ in range(300)] + ["", " "]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encode_texts(texts, tokenizer_path()) == want


def test_a_batch_is_tokenised_in_small_parts(words):
    text = " ".join(words(400, 1))
    texts = [text] * (2_000_000 // len(text))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "body"])
    [*cut_pieces(iter([batch.slice(0, 1)]), tokenizer_path(), 4096, 1)]  # the table of words is there
    tracemalloc.start()
    n = sum(out.num_rows for out in cut_pieces(iter([batch]), tokenizer_path(), 4096, 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and peak < 12_000_000  # parts of 512 KB took 22 MB


def test_pieces_and_sequences(table, words):
    from tokenizers import Tokenizer

    rows = [(i, " ".join(words(1 + i * 7 % 90, i))) for i in range(200)]
    rows += [(500, " ".join(words(3000, 1))), (501, None), (502, ""), (3, "again"), (None, "null id")]
    placed = pack(tokenised_pieces(table(rows), tokenizer_path(), 128), 128, group_items=20).collect()
    sequences = check(placed, 128)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, a, len(ids[a:a + 128]), zlib.crc32(struct.pack(f"<{len(ids[a:a + 128])}I", *ids[a:a + 128])))
                 for k, a in enumerate(range(0, len(ids), 128))]
    got = [(r.id, r.piece, r.start, r.length, r.ids_crc32) for r in placed]
    assert sorted(map(str, got)) == sorted(map(str, want))
    one_group = len(best_fit(sorted((r.length for r in placed), reverse=True), 128)[2])
    assert math.ceil(sum(r.length for r in placed) / 128) <= sequences <= 1.05 * one_group


def test_empty(table):
    assert pack(tokenised_pieces(table([]), tokenizer_path(), 128), 128).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_bin(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 50) for _ in range(200)), reverse=True)
    bins, offsets, fill = best_fit(lengths, 50)
    rooms: dict[int, int] = {}
    for n, b, o in zip(lengths, bins, offsets):
        fit = [r for r in rooms.values() if r >= n]
        if fit:
            assert rooms[b] == min(fit)
        else:
            assert b not in rooms
        assert o == 50 - rooms.get(b, 50)
        rooms[b] = rooms.get(b, 50) - n
    assert max(fill) <= 50


def test_a_small_table_of_words_gives_the_same_ids(monkeypatch):
    """With 8 rows nearly every word displaces another; long words never enter."""
    from tokenizers import Tokenizer

    from archivesearch.llm import packing

    rng = random.Random(8)
    pool = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(60)] + ["x" * 200, "12345678901234567890"]
    small = packing.WordIds(tokenizer_path(), bits=3)
    monkeypatch.setattr(packing, "word_ids", lambda path: small)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for _ in range(30):
        texts = [" ".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(5)]
        want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert encode_texts(texts, tokenizer_path()) == want


def test_clashing_columns_and_very_long_text(spark, table, words):
    long = " ".join(words(150_000, 3))
    docs = table([(1, long, 4, "z", 5, 6), (2, "a b", 4, "z", 5, 6)],
                 "doc_id bigint, text string, piece int, grp string, length int, bin bigint")
    placed = pack(tokenised_pieces(docs, tokenizer_path(), 4096), 4096).collect()
    check(placed, 4096)
    assert sum(r.length for r in placed if r.id == 1) == len(encode_texts([long], tokenizer_path())[0]) // 4 + 1
