"""Token files of texts that hold a special token."""

import zlib

import numpy as np

from lakemart.llm import token_files


def test_special_tokens_in_texts(spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(token_files.default_vocabulary())
    s = "<|endoftext|>"
    texts = [f"end of one {s} start of next", f"end{s}start", f"end {s}start", f"end{s} start", s, f" {s} ", f"a  {s}  b", f"a {s}{s} {s} b",
             f"x\n{s}\ny {s}, z", f"{s}'s it {s}'s", f"a {s[:5]} {s[5:]} b", f"(a {s}) {s}1 {s}"]
    want = {i: plain.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert len(plain.encode(s, add_special_tokens=False).ids) == 1
    got = token_files.token_table(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {
        i: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in want.items()}
