from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from remitspark.llm import packing
from remitspark.llm.textarrays import text_bytes
from tests.llm.conftest import rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a'sb I'LL  don't x'S.", "É É Ώδε ΣΑΣ σ. İ i̇", "a b\x1cc\x85d a b", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
    "abc., d.,e .f ,.", "漢字 kanji1 23a\tb\r\nc", "é ́ a ̣́", "'s 's't n'T", "İX. K. ſ. x_y a_ b! c!!? Å", "\U0001f600 ok 𝒳y",
]


def reference(texts):
    return [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("words, parts", [(2_000_000, 500_000), (40, 5)])
def test_ids_are_those_of_the_tokenizer(monkeypatch, texts, words, parts):
    monkeypatch.setattr(packing, "CACHED_WORDS", words)
    monkeypatch.setattr(packing, "CACHED_PARTS", parts)
    kept = packing.WordIds(PATH)
    for some in (ODD, texts, ODD + texts):
        flat, bounds = kept.of(*text_bytes(pa.array(some)))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == reference(some)


@pytest.mark.parametrize("ways", [1, 2, 7])
def test_difference_is_a_partition_with_near_equal_sums(ways):
    rnd = random.Random(ways)
    lengths = [rnd.randint(1, 100) for _ in range(90)]
    groups = packing.difference(lengths, ways)
    assert sorted(i for g in groups for i in g) == list(range(90))
    sums = [sum(lengths[i] for i in g) for g in groups]
    assert max(sums) - min(sums) <= 5
    assert packing.difference([], 3) == []


def test_windows_rise_when_capacity_is_exceeded():
    assert len(packing.pack_block([60, 60, 60], 100)) == 3
    assert packing.pack_block([50, 50], 100) == [[0, 1]]


@pytest.mark.parametrize("window", [2048, 16])
def test_pieces_cover_all_ids_once(spark, odd_docs, window):
    found = packing.pack_documents(odd_docs, tokenizer=PATH, window=window)
    got = rows_of(found, "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    want = defaultdict(int)
    for doc_id, text in rows_of(odd_docs, "doc_id", "text"):
        want[doc_id, tuple(reference([text or ""])[0] + [1])] += 1
    by_sequence, pieces = defaultdict(list), defaultdict(int)
    for doc_id, start, length, crc, n, sequence, offset in got:
        by_sequence[sequence].append((offset, length))
        pieces[doc_id, start, length, crc, n] += 1
    for (doc_id, ids), copies in want.items():
        array = np.array(ids, "<u4")
        covered = 0
        while covered < len(ids):  # rows that are alike are cut alike
            found = [k for k in pieces if k[0] == doc_id and k[1] == covered and k[4] == len(ids) and pieces[k] >= copies
                     and k[3] == zlib.crc32(array[covered : covered + k[2]].tobytes())]
            assert found, (doc_id, covered)
            pieces[found[0]] -= copies
            covered += found[0][2]
    assert not any(pieces.values())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window


def test_little_padding(spark, sf):
    found = packing.pack_documents(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer=PATH)
    filled = found.groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert filled.sum() / (2048 * len(filled)) > 0.97


def test_no_documents(spark, no_docs):
    assert packing.pack_documents(no_docs, tokenizer=PATH).collect() == []
