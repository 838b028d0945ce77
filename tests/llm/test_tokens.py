from __future__ import annotations

import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import tokens

PATH = tokens.vocabulary_path("byte_bpe_50k")
pytestmark = pytest.mark.skipif(not Path(PATH).exists(), reason="no vocabulary files")


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abt hein\n'sS", max_size=80), st.text("가나다라 学é😀", max_size=40)))
def test_like_the_public_one(public, text):
    assert list(tokens.encoder(PATH).encode(text)) == public(text)


def test_special_cases(public):
    e = tokens.encoder(PATH)
    for text in ("", " ", "<|endoftext|>", "a" * 5000, "=" * 3000, "​﻿", "한글" * 2000, "\r\n\t  \n x  y", "it's I'LL", "".join(map(chr, range(1, 700)))):
        assert list(e.encode(text)) == public(text), text[:20]
        assert e.count(text) == len(public(text))
    assert list(e.encode(None)) == []


def test_long_pretoken():
    e = tokens.encoder(PATH)
    assert bytes().join(b"x" for _ in e.encode("x" * 300_000)) and len(e.encode("0123456789" * 30_000)) > 0


def test_append_and_edit():
    random.seed(1)
    v = tokens.encoder(PATH).vocabulary
    whole = lambda data: tokens.Prefixes(v, data)
    for _ in range(300):
        data = bytes(random.choice(b"abt hein\xea\xb0\x80") for _ in range(random.randint(0, 60)))
        cut = random.randint(0, len(data))
        p = whole(data[:cut])
        p.append(data[cut:])
        assert (p.last, p.size) == (whole(data).last, whole(data).size)
        a, b = sorted(random.choices(range(len(data) + 1), k=2))
        new = bytes(random.choice(b"the in") for _ in range(random.randint(0, 5)))
        p.replace(a, b, new)
        assert (p.last, p.size, p.ids()) == (whole(data[:a] + new + data[b:]).last, whole(data[:a] + new + data[b:]).size, whole(data[:a] + new + data[b:]).ids())
    text = b"".join(random.choice([b"the", b"ing", b"zq", b"a"]) for _ in range(5000))
    assert whole(text).replace(5000, 5001, b"XY") < 1000


def test_tables(spark, rows):
    df = spark.createDataFrame([(1, "hello world"), (1, "hello world"), (2, ""), (None, None)], "doc_id long, text string").withColumns({"ids": F.lit(1), "tokens": F.lit(2)})
    assert rows(tokens.encode_texts(df, "doc_id", "text")) == sorted([(1, [31373, 995]), (1, [31373, 995]), (2, []), (None, [])], key=repr)
    assert rows(tokens.token_counts(df, "doc_id", "text")) == sorted([(1, 2), (1, 2), (2, 0), (None, 0)], key=repr)
    assert tokens.encode_texts(df.limit(0), "doc_id", "text").count() == 0
