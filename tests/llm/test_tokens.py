"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallybrook.llm import byte_tokens as bt
from tallybrook.llm import queries
from tallybrook.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bt.Coder(PATH)


def test_pattern_is_the_given_one():
    assert bt.PATTERN == public_tokenizers.PATTERN


def test_query_equals_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = queries.op13_byte_tokens(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_classes_of_all_code_points():
    """The library merges a code point with a leading sign exactly if both are of one class."""
    table = bt.class_table()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lead, kind in (("a", bt.LETTER), ("1", bt.NUMBER), ("!", bt.OTHER), ("\n", bt.SPACE)):
        ranks = {bytes([i]): i for i in range(256)}
        for i in range(256):
            ranks.setdefault(lead.encode() + bytes([i]), 256 + i)
        seen = tiktoken.Encoding("own", pat_str=bt.PATTERN, mergeable_ranks=ranks, special_tokens={})
        same = np.array([seen.encode_ordinary(lead + chr(c))[0] >= 256 for c in points])
        assert (same == (table[points] == kind)).all()


def test_slices_equal_the_pattern(library, coder):
    pieces = [
        "'", "s", "t", "re", "ve", "ll", "m", "d", "r", "v", "l", " ", "  ", "\n", "\t", " ", " ", "a",
        "Z", "é", "漢", "🙂", "1", "²", "٣", ".", "!!", "\U00013460", "\x00", "\U0010ffff", "'s", "''", "́",
    ]
    rng = random.Random(1)
    texts = ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(4000)]
    for text, parts in zip(texts, bt.slices(texts)):
        assert "".join(parts) == text
        ids = coder.encode(parts)
        assert ids.tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
        assert [text.encode()[o:] .startswith(coder.tokens[i]) for i, o in zip(ids, coder.offsets(ids))] == [True] * len(ids)


def test_long_slices(library, coder):
    rng = random.Random(2)
    texts = ["a" * 3000, "ab" * 1500, "".join(rng.choices("abcdeth", k=5000)), "!" * 999, " " * 777 + "x", "漢字" * 400]
    for text, parts in zip(texts, bt.slices(texts)):
        assert coder.encode(parts).tolist() == library.encode_ordinary(text)
        raw = parts[0].encode()[:60]
        assert coder._merge_long(raw) == coder._merge_short(raw)


def test_scan_does_not_depend_on_rows():
    """One long text and the same cut into many give the same slices inside."""
    rng = random.Random(3)
    words = ["it's", " we'll", "  two", "\n\n", " 12", "?!", " \t", "d'accord", "'", " '"]
    lines = ["x" + "".join(rng.choices(words, k=rng.randrange(30))) + "x" for _ in range(3000)]
    apart = [p for parts in bt.slices(lines) for p in [*parts, "\n"]]
    together = bt.slices(["\n".join(lines) + "\n"])[0]
    assert together == apart


def test_awkward_rows(messy, nothing, library):
    rows = {(r.doc_id, r.n_tokens) for r in bt.digest_documents(messy).collect()}
    source = [(r.doc_id, r.text or "") for r in messy.collect()]
    assert rows == {(i, len(library.encode_ordinary(t))) for i, t in source}
    assert bt.digest_documents(messy).count() == len(source)
    encoded = bt.encode_documents(messy)
    got = sorted((str(r.doc_id), bytes(r.decoded)) for r in bt.decode_documents(encoded).collect())
    assert got == sorted((str(i), t.encode()) for i, t in source)
    assert bt.digest_documents(nothing).count() == 0
    assert bt.decode_documents(bt.encode_documents(nothing)).count() == 0


def test_forgotten_slices(monkeypatch, library):
    monkeypatch.setattr(bt, "CACHED", 3)
    monkeypatch.setattr(bt, "CHARACTERS", 10)
    coder = bt.Coder(PATH)
    texts = ["one two three four five six seven", "", "one two", "x" * 100]
    groups = list(bt.batches(texts))
    assert [t for g in groups for t in g] == texts
    done = [coder.encode(p).tolist() for g in groups for p in bt.slices(g)]
    assert done == [library.encode_ordinary(t) for t in texts]
    assert len(coder) <= 3
