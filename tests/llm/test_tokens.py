"""Ids of words that Arrow splits are the tokenizer's own, and packing passes whole windows on once."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fraudfeatures.llm import packing
from fraudfeatures.llm.common import checkpoint_root
from fraudfeatures.llm.tokens import WordTokenizer

PIECES = ["'", "'", "s", "t", "re", "ve", "m", "ll", "d", "1", "²", "½", "é", "É", "ª", "µ", "×", "ß", "Ⱥ", "İ", ".", ",", "|", "<|", "日本", "é", "\x0b", "\xa0", " ", " ", "\n", "word"]


@pytest.mark.parametrize("most_words", [7, 400_000])
def test_ids_are_the_tokenizers(most_words):
    rng = random.Random(5)
    plain = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(12))) for _ in range(4000)] + [chr(c) for c in range(0x250)]
    texts += ["".join(chr(rng.choice([*range(0x20, 0x7F), *range(0xA1, 0x250)])) for _ in range(20)) for _ in range(1000)]
    tokenizer, at = WordTokenizer(packing.tokenizer_path(), most_words), 0
    while at < len(texts):  # in parts, with the words of the parts before
        some = texts[at : at + rng.randrange(1, 900)]
        found = tokenizer.encode(pa.array(["", *some, ""])[1:-1]).to_pylist()
        assert [np.frombuffer(x, np.uint16).tolist() for x in found] == [x.ids for x in plain.encode_batch(some, add_special_tokens=False)]
        assert len(tokenizer.words) == len(tokenizer.ids) <= most_words
        at += len(some)
    for none in ([], [""], ["", " \n"]):
        assert tokenizer.encode(pa.array(none, pa.string())).to_pylist() == [b""] * len(none)


def test_each_distinct_word_is_looked_up_once(monkeypatch):
    """Not once for each place where it stands: a text of few words costs as many look-ups as these."""
    tokenizer, looked_up = WordTokenizer(packing.tokenizer_path()), []
    own = WordTokenizer._ids_of
    monkeypatch.setattr(WordTokenizer, "_ids_of", lambda self, words: looked_up.append(len(words)) or own(self, words))
    tokenizer.encode(pa.array(["a b, a b, a", "b a " * 1000]))
    assert looked_up == [3]


def test_whole_windows_are_written_once(spark):
    """The tokens have them in their last form; they are neither read again by Python nor written again."""
    root = checkpoint_root(spark).removeprefix("file://")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    docs = spark.createDataFrame([(i, "one two three " * n) for i, n in enumerate((0, 1, 5, 21, 40, 200))], "doc_id long, text string")
    pieces = packing.retrieval_packing(docs, packing.tokenizer_path(), 64)
    assert {name.split("-")[0] for name in set(os.listdir(root)) - before} == {"tokens", "packed"}
    rows = pieces.toPandas()
    full = rows[rows.sequence_id >= packing.FULL]
    assert (full.length == 64).all() and len(full) == sum((3 * n + 1) // 64 for n in (0, 1, 5, 21, 40, 200)) and full.sequence_id.is_unique
    assert rows.groupby("doc_id").length.sum().to_dict() == {i: 3 * n + 1 for i, n in enumerate((0, 1, 5, 21, 40, 200))}
