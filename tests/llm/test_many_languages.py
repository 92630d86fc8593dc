"""Language identification with more languages than the sample has rows for."""

import random

import numpy as np

from lakemart.llm import langid


def test_every_language_is_learned(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(4)), f"l{i % 520:03}") for i in range(520 * 3)]
    rows += [(10_000 + i, "x y", "big") for i in range(4000)]
    seen = []

    class Stop(Exception):
        pass

    def model(langs, x, y):
        seen.extend([langs, np.bincount(y, minlength=len(langs))])
        raise Stop
    kept, langid.Model = langid.Model, model
    try:
        langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample=520)
    except Stop:
        pass
    finally:
        langid.Model = kept
    assert seen[0] == sorted({r[2] for r in rows})
    assert (seen[1][1:] == 3).all() and seen[1][0] >= langid.LEAST


def test_losses_equal_their_definition():
    rng = np.random.default_rng(1)
    m, code, weight = rng.normal(size=(5, 40)) * 20, langid.codewords(9), None
    m = m[:, :1].repeat(code.shape[1], 1) * rng.normal(size=code.shape[1])
    weight = rng.random(code.shape[1])
    z = np.clip(m[:, None, :] * code[None], -30, 30)
    want = (np.log1p(np.exp(-z)) * weight).sum(axis=2) / weight.sum()
    assert np.allclose(langid.losses(m, code, weight), want)
