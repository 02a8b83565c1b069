"""Language identification with more languages than one weight table holds."""

import random

import numpy as np

from tidemark.llm import langid

LANGS = 1500


def text_of(rng, words):
    return " ".join(rng.choice(words) for _ in range(60))


def test_fifteen_hundred_languages(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:04d}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(12)] for i in range(LANGS)}
    rows = [(10_000 * k + i, text_of(rng, w), lang) for i, (lang, w) in enumerate(words.items()) for k in range(4, 8)]
    rows += [(1, None, None), (2, "123", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in langid.language(docs).collect()}
    known = [(d, lang) for d, _, lang in rows if lang]
    assert np.mean([got[d]["lang_pred"] == lang for d, lang in known]) > 0.97
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_blocks_solve_the_same_regression():
    rng = np.random.default_rng(1)
    langs = [f"x{i // 5}" for i in range(100)]
    base = rng.random((20, langid.SPACE)) < 0.01
    bits = (base[np.arange(100) // 5] ^ (rng.random((100, langid.SPACE)) < 0.002)).astype(np.uint8)
    one, many = langid.fit(bits, langs, landmarks=20), langid.fit_blocks(np.packbits(bits, axis=1), langs)
    assert one.langs == many.langs
    assert np.abs(one.scores(bits) - many.scores(bits)).max() < 1e-3
