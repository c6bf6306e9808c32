"""BPE: the tokenizers library as brute force, round trips, long unsplit text, odd rows."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from hiermatch.llm import bpe
from hiermatch.llm.queries import QUERIES

from .test_ops import ODD, clash, frame


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.default_vocabulary())


def ids(vocab, text):
    return np.frombuffer(vocab.encode(text), np.int32).tolist()


def test_every_character_class(vocab, library):
    """Each code point beside a letter, a digit, a mark, blanks: the split is the library's."""
    text = [c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff"]
    for i in range(0, len(text), 997):
        t = "".join(f"a{c}1{c}.{c} {c}\n" for c in text[i:i + 997:5])
        assert ids(vocab, t) == library.encode(t, add_special_tokens=False).ids


def test_random_texts(vocab, library):
    rng = random.Random(1)
    bits = ["a", "b", " ", "\n", "'s", "é", "<|endoftext|>", "1", "中", "😀", "-", "aa", "the", "\xa0", "\x85", "\x1c", "\u200b", "<|endof"]
    for _ in range(1500):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        assert ids(vocab, t) == (want := library.encode(t, add_special_tokens=False).ids), t
        assert vocab.decode(want) == library.decode(want, skip_special_tokens=False) == t
    for _ in range(30):  # any ids, so broken UTF-8 too
        some = [rng.randrange(50257) for _ in range(500)]
        assert vocab.decode(some) == library.decode(some, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 5001, "ab" * 3000, "-" * 7777, " " * 4099, "é" * 3001, "\n" * 999, "the" * 5000, "0" * 3333 + "12" * 2222,
                                  "".join(random.Random(2).choice("abcdefgh") for _ in range(20_000)), "".join(random.Random(3).choice("aA") for _ in range(30_000))])
def test_long_unsplit_text(vocab, library, text):
    assert ids(vocab, text) == library.encode(text, add_special_tokens=False).ids


def test_join_of_any_halves(vocab):
    rng = random.Random(4)
    for _ in range(300):
        raw = "".join(rng.choice(["a", "b", "the", "ing", "x"]) for _ in range(rng.randint(2, 80))).encode()
        at = rng.randrange(len(raw) + 1)
        assert vocab.join(vocab.merge(raw[:at]), vocab.merge(raw[at:])) == vocab.merge(raw)


def test_long_texts_in_pieces(spark, library):
    """Texts over the piece size: cut at pre-tokens, unsplit runs joined level by level, copies encoded once."""
    rng = random.Random(5)
    texts = ["a b c " * 90, "x" * 700 + " y" * 40, "   " * 200 + "a" * 300, "ab1" * 300 + "<|endoftext|>" * 50, "<|endoftext|>" * 60, "é" * 777, "q" * 129,
             "".join(rng.choice("abc de1.\n") for _ in range(2000)), "x" * 700 + " y" * 40, "", "short", None, "中文" * 200 + " \u2028 " * 30]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (3, texts[0])]
    for piece in (64, 101, 1 << 18):
        out = bpe.decode(bpe.encode(clash(frame(spark, rows)), piece=piece)).collect()
        want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows)
        assert sorted((str(r.doc_id), list(r.ids), r.text) for r in out) == want


def test_odd_rows_and_string_ids(spark, library):
    out = bpe.decode(bpe.encode(clash(frame(spark, ODD)))).collect()
    assert sorted((str(r.doc_id), list(r.ids), r.text) for r in out) == sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in ODD)
    assert bpe.decode(bpe.encode(frame(spark, []))).count() == 0
    named = bpe.encode(frame(spark, [("k", "a b")], "doc_id string, text string"))
    assert named.schema["doc_id"].dataType.simpleString() == "string" and named.first().ids == library.encode("a b").ids
    lost = bpe.decode(spark.createDataFrame([(1, None), (2, []), (3, [15496, 99999])], "doc_id long, ids array<int>"))
    assert {r.doc_id: r.text for r in lost.collect()} == {1: None, 2: "", 3: "Hello"}


def test_query_equals_the_library(spark, sf, library):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        found = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(found), sha(",".join(map(str, found))), sha(library.decode(found, skip_special_tokens=False))))
    assert {tuple(r) for r in QUERIES["op13_bpe"](spark, sf).collect()} == want
