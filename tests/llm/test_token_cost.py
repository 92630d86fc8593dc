"""Steps of the token coder and of the piece cache that cost CPU seconds, and their results."""
import numpy as np
import pytest
from lakemart.llm import token_files


def test_classes_are_looked_at_once_in_a_while(monkeypatch):
    """The shares of the bit-length classes, the dearest part of a step, are not renewed at every id."""
    looks, real = [], token_files._Model.count
    monkeypatch.setattr(token_files._Model, "count", lambda self, key: (looks.append(1), real(self, key))[1])
    ids = (np.random.default_rng(6).zipf(1.3, 20_000) % 50_257).astype(np.uint32)
    assert (token_files.unpack(token_files.pack([1], [len(ids)], ids))[2] == ids).all()
    assert len(looks) == 2 * token_files.BLOCK // token_files.REFRESH


@pytest.mark.parametrize("text", ["a b", " a b", "a b ", "a  b", "a\n b", "a \nb", "a\nb c", "a  b", "a　b  c", "é b\x1fc", ""])
def test_cut_texts_equal_whole_ones(text):
    coder = token_files.Ids(token_files.default_vocabulary())
    texts = [text, text + " tail " + text, text]
    want = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):                                            # new pieces, then known ones
        assert [i.tolist() for i in coder.encode(texts)] == want


def test_full_cache_starts_again(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 3)
    coder = token_files.Ids(token_files.default_vocabulary())
    for n in range(4):
        texts = [f"head one{n} two three{n} four\nfive six", f"x y{n}"]
        assert [i.tolist() for i in coder.encode(texts)] == [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(coder.known) == len(coder.start) <= 3 + 7
