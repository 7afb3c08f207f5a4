import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from foldlake.llm import common, token_records as tr

TEXTS = ["the cat", None, "", " ", "a  b", "\n", "don't stop", "é ß 漢字 🙂", "x" * 3000, "<|endoftext|> here", "before <|endoftext|> after", "in<|endoftext|>side  <|endoftext|>", "tab\tand\r\nlines\n\n", "the cat", "word " * 500]


def plain(texts):
    tokenizer = Tokenizer.from_file(tr.default_tokenizer())
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


def test_round_trip(spark, documents):
    ids = [5, 3, None, 3, 9, 1, 2, 8, 7, 6, 14, 15, 10, 11, 12]
    df = documents(list(zip(ids, TEXTS)))
    manifest = tr.write(df, common.work_path(spark, "records"), tr.default_tokenizer())
    got = sorted(map(tuple, tr.summarize(spark, manifest).collect()), key=lambda r: r[1])
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, TEXTS[i] or ""))
    start = 0
    for row, i in zip(got, order, strict=True):
        want = plain([TEXTS[i]])[0]
        assert row == (ids[i], start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    path = manifest.first().path
    assert sorted(tr.shuffled(path, 3), key=str) == sorted(tr.records(path), key=str)
    offset, n = tr.offsets(path)[0]
    assert len(tr.read_at(path, offset)[1]) == 4 * n


def test_damage_is_found(spark, documents, tmp_path):
    manifest = tr.write(documents([(1, "some text here")]), f"file://{tmp_path}/r", tr.default_tokenizer())
    path = manifest.first().path
    file = tmp_path / "r" / path.rsplit("/", 1)[1]
    data = bytearray(file.read_bytes())
    data[-6] ^= 1
    file.write_bytes(data)
    with pytest.raises(ValueError):
        list(tr.records(path))


def test_empty_table(spark, documents):
    manifest = tr.write(documents([]), common.work_path(spark, "records"), tr.default_tokenizer())
    assert tr.summarize(spark, manifest).count() == 0


def test_pieces_give_the_ids_of_whole_texts():
    import random

    random.seed(7)
    parts = ["a", "<|endoftext|>", "straße", "naïve,", "word.)", "x!?", "the", "don't", " ", "  ", "\n", "\t", " \n", " ", ",", "...", "42", "é", "'ll", "\x85", "🙂", "(", "\r\n", "´"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(3000)]
    coder = tr.PieceEncoder(tr.default_tokenizer())
    want = [coder.pack(e.ids) for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [coder.encode(text) for text in texts] == want
    assert coder.encode_column(pa.array(texts)) == want
    assert coder.encode_column(pa.array(texts)) == want  # from memory


def test_files_with_another_pre_tokenizer_are_not_cut():
    import public_tokenizers

    coder = tr.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["The cat sat, on the mat.", "", "  spaces  here ", "<|endoftext|> don't"]
    assert coder.encode_column(pa.array(texts)) == [coder.pack(coder.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert not coder.cuts


def test_long_texts_are_cut(monkeypatch):
    import re

    monkeypatch.setattr(tr, "CHUNK", 50)
    monkeypatch.setattr(tr, "_PARTS", re.compile(r".{50}.*?\S(?= \S)|.+", re.S))
    coder = tr.PieceEncoder(tr.default_tokenizer())
    for text in ("the cat sat  on\n the mat, don't you think so? " * 100, "y" * 1000):
        assert coder.encode(text) == coder.pack(coder.tokenizer.encode(text, add_special_tokens=False).ids)
