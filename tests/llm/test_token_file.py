import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorelake.llm import token_file
from scorelake.llm.common import new_folder
from scorelake.llm.queries import TOKENIZERS
from tests.llm.docs import awkward, prose, table

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 4096, 20_000])
def test_round_trip_of_ids(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.5, rng.integers(0, 5, n), rng.integers(0, 2**32, n)).astype(np.uint32)
    keys, lengths, back = token_file.unpack(token_file.pack([None, 7], [n, 0], ids))
    assert keys == [None, 7] and lengths == [n, 0] and (back == ids).all()


def test_predictions_that_nearly_always_hold():
    rng = np.random.default_rng(8)
    runs = []
    for _ in range(400):  # order 2 is right for long, then only order 1 is
        a, b = rng.integers(0, 6, 2)
        runs += [a, b] * 60 + [7, b, b]
    ids = np.array(runs, dtype=np.uint32)
    assert (token_file.unpack(token_file.pack([1], [len(ids)], ids))[2] == ids).all()


def test_damage_is_noticed():
    ids = np.arange(9000) % 500
    data = bytearray(token_file.pack([1], [9000], ids.astype(np.uint32)))
    data[-50] ^= 1
    with pytest.raises(ValueError):
        token_file.unpack(bytes(data))
    with pytest.raises(ValueError):
        token_file.unpack(bytes(data[:-2]))


def test_files_of_documents(spark, monkeypatch):
    monkeypatch.setattr(token_file, "FILE_IDS", 3000)
    texts = awkward() + [(20 + i, prose(i, 50 * i) + " it's <|endoftext|> ÄÖ\tx　y") for i in range(20)]
    folder = new_folder(spark, "ids")
    files = token_file.write_token_files(table(spark, texts), PATH, folder, 2)
    assert files.count() > 1
    got = token_file.read_token_files(spark, files, folder).collect()
    plain = Tokenizer.from_file(PATH)
    want = sorted((str(k), [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for k, t in texts)
    assert sorted((str(r.key), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert all(r.n_tokens * 4 == len(r.ids) and zlib.crc32(bytes(r.ids)) for r in got)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.key for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)


def test_words_of_all_kinds_equal_the_library():
    import pyarrow as pa

    texts = ["Hello, WORLD! it's don't I'LL", "ÀÉÎ straße ĮŻ İstanbul ΟΔΟΣ", "x<|endoftext|>y <|startoftext|>", "3.14 1,000 a1b2 ... ?!--", "", None, "  two  spaces\n\nlines ", "café e\u0301 ½ ² º µ", "tab\there\u00a0nbsp\u3000wide", "日本語 🙂👍 ok", "word " * 50, "Aa" * 4000]
    plain = Tokenizer.from_file(PATH)
    words = token_file.Words(PATH)
    for _ in range(2):  # learnt, then remembered
        found = [(n, ids) for n, ids in words.encode(pa.array(texts))]
        got = [ids[e - n : e].tolist() for sizes, ids in found for n, e in zip(sizes, sizes.cumsum())]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_the_memory_of_words_is_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_file, "_REMEMBERED_BYTES", 4000)
    words = token_file.Words(PATH)
    for i in range(5):
        list(words.encode(pa.array([prose(i, 2000)])))
    assert words.spent <= 4000 and len(words.known) <= 4000 // 190


def test_empty_table(spark):
    folder = new_folder(spark, "ids")
    files = token_file.write_token_files(table(spark, awkward()).where(F.lit(False)), PATH, folder, 2)
    assert token_file.read_token_files(spark, files, folder).count() == 0


def test_enough_blocks_advance_together():
    """A step over few blocks costs about as much as one over many; 3,072 blocks a file were too few for the budget."""
    assert token_file.FILE_IDS // token_file.BLOCK >= 5000
    assert token_file._REMEMBERED_BYTES >= 200_000 * (token_file._WORD_COST + 16)  # the common words of a large corpus
