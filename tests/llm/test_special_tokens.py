"""Texts that hold the tokenizer's added tokens are encoded as the library does."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestone.llm import idfiles

TEXTS = ["a<|endoftext|>b", "<|endoftext|>", "a  <|endoftext|>  b\n<|endoftext|> c", "x <|endoftext|><|endoftext|>y", "<|endoftext", "a <|endof text|>"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(idfiles.tokenizer_file())


@pytest.mark.parametrize("text", TEXTS)
def test_pieces(plain, text):
    got = np.frombuffer(idfiles.Encoder(idfiles.tokenizer_file()).encode([text])[0], "<u4").tolist()
    assert got == plain.encode(text, add_special_tokens=False).ids


def test_files(spark, plain):
    got = idfiles.read(idfiles.write(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))).collect()
    ids = {i: np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in enumerate(TEXTS)}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == {(i, len(x), zlib.crc32(x.tobytes())) for i, x in ids.items()}
