"""Operator 9 against the tokenizers library."""

import random

import numpy as np
import pytest
from llm_data import awkward

from essayspark.llm.bpe import Coder, encode_documents, tokenizer_path

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(NAME))


def truth(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(2)
    run = "".join(rng.choice("abcdeéüñthing") for _ in range(900))
    return ["It's <|endoftext|> we'LL <|startoftext|>x", run, f"start {run} middle {run[:77]}end", "日本語" * 60, "Σςσ İ ½ ² 9 99", "a\u0085b\x1fc d",
            "é Å", "!?#$" * 70, "🙂 ok", "<|endoftext|>" * 3, "é" * 300]


def test_documents(frame, library):
    texts = awkward(6) + list(enumerate(odd_texts(), 200)) + [(201, odd_texts()[1])]
    got = sorted(((r.doc_id, r.n_tokens, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.decoded)
                  for r in encode_documents(frame(texts), NAME, piece=50, leaf=8).collect()), key=str)
    want = []
    for i, t in texts:
        ids, decoded = truth(library, t)
        want.append((i, len(ids), ids, decoded))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("leaf", [1, 3, 16])
def test_tree_concatenation(library, leaf):
    rng = random.Random(leaf)
    coder = Coder(tokenizer_path(NAME), leaf=leaf)
    for _ in range(60):
        parts = rng.choice([["a", "b"], ["the", "ing", "tion", "a", "qu"], list("abcdefghijklmnopqrstuvwxyz"), ["é", "ü", "日"]])
        word = "".join(rng.choice(parts) for _ in range(rng.choice([1, 7, 60, 700])))
        (ids, decoded), = coder.encode([word])
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == truth(library, word)


def test_empty_table(frame):
    assert encode_documents(frame([]), NAME).collect() == []
