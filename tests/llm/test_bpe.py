import random

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer as Library

from tallyhawk.llm.bpe import ASCII_SPLIT, SPACE, Automaton, Tokenizer, byte_symbols, decode, encode, joined

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\t", "Hello WORLD's it'll 123", "<|startoftext|>Hi<|endoftext|> <|ENDOFTEXT|> <|startoftext|", "don'T I'M 'S",
       "ΣΑΣ İstanbul ß ǅ é Å", "日本語 ١٢٣ ½", "a\x1cb\x85c​d﻿e　f",
       "\U0001f600\U0001f600 \U0001f469‍\U0001f467", "\x00\x01\x7f", "$$$ %%%*** !!", "th" * 5000, "a" * 20_000, "x " * 5000]


@pytest.fixture(scope="module")
def ours():
    return Tokenizer(PATH)


def test_as_the_library(ours):
    rng = random.Random(3)
    tokens = sorted(t for t in ours.labels if t is not None)
    texts = ODD + ["".join(rng.choice(tokens).replace("</w>", rng.choice(["", " "])) for _ in range(rng.randrange(1, 9)))
                   for _ in range(1500)]
    library, worker = Library.from_file(PATH), ours.worker()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = worker.encode(text)
        assert ids.tolist() == want.ids, text[:50]
        assert joined(ours.labels, ids) == library.decode(want.ids, skip_special_tokens=False)
    assert joined(ours.labels, np.array([1, 10 ** 9, 2])) == joined(ours.labels, np.array([1, 2]))


def test_split(ours):
    """The faster split of ASCII is the one that the file names."""
    plain = regex.compile(ours.pattern.replace(r"\s", SPACE)).findall
    rng, chars = random.Random(5), [chr(c) for c in range(128)] + list("''stremvld  ")
    for _ in range(3000):
        text = "".join(rng.choice(chars) for _ in range(30)).lower()
        assert ASCII_SPLIT.findall(text) == plain(text)


def test_automaton_is_bpe():
    """On random merges over a small alphabet: as merging pair by pair."""
    rng = random.Random(4)
    marks = byte_symbols()
    for _ in range(60):
        known, merges = [marks[ord(c)] for c in "abc"], []
        vocab = {c: i for i, c in enumerate(known)}
        for _ in range(12):
            pair = rng.choice(known), rng.choice(known)
            if "".join(pair) not in vocab:
                vocab["".join(pair)] = len(vocab)
                merges.append(pair)
                known.append("".join(pair))
        automaton, rank, table = Automaton(vocab, merges), {p: i for i, p in enumerate(merges)}, {}
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
            parts = list(word)
            while pairs := [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]:
                _, i = min(pairs)
                parts[i:i + 2] = ["".join(parts[i:i + 2])]
            assert automaton.encode(word.encode(), table) == [vocab[p] for p in parts]


def test_frames(spark, ours):
    schema = "text string, doc_id long, ids string, _coded int"
    docs = spark.createDataFrame([(t, i, "x", 1) for i, t in enumerate([*ODD, None, None])], schema)
    coded = encode(docs, PATH)
    assert coded.columns == ["doc_id", "_coded", "ids"]
    back = decode(coded, PATH).collect()
    worker = ours.worker()
    assert sorted((r["doc_id"], r["ids"], r["text"]) for r in back) == [
        (i, worker.encode(t or "").tolist(), joined(ours.labels, worker.encode(t or ""))) for i, t in enumerate([*ODD, None, None])]
    both = encode(docs, PATH, decoded_col="text")
    assert sorted((r["doc_id"], r["ids"], r["text"]) for r in both.collect()) == sorted((r["doc_id"], r["ids"], r["text"]) for r in back)
    empty = spark.createDataFrame([], schema)
    assert decode(encode(empty, PATH), PATH).count() == 0
    nulls = spark.createDataFrame([(None, 1), ([5, -3], 2)], "ids array<int>, doc_id int")
    assert {r["doc_id"]: r["text"] for r in decode(nulls, PATH).collect()} == {1: "", 2: joined(ours.labels, np.array([5]))}
