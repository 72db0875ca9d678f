"""Each document operator against a plain Python version, and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import licenses, mixing, near_copies, packing, pii, quality, queries, repeats
from tallybrook.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return texts(spark, sf_dir)


def base_statistics(text):
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark, sf_dir, corpus):
    rows = queries.op10_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == base_statistics(corpus[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_outliers(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(5000)]
    rows = [(i, " ".join(rng.choice(vocabulary, 120)), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{w}###$$$" for w in rng.choice(vocabulary, 120)), "en", "s") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge_documents(spark, docs).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(5))
    assert {r.doc_id for r in quality.keep_good_documents(spark, docs).collect()} == set(range(300))


def test_quality_judges_each_statistic_in_groups_of_any_size(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(5000)]

    def line(n=10):
        return " ".join(rng.choice(vocabulary, n))

    def document():
        return "\n".join(line() for _ in range(12))

    passage = line(30)
    junk = {
        "length": "\n".join(" ".join(f"{w}{'x' * 20}" for w in rng.choice(vocabulary, 10)) for _ in range(12)),
        "symbols": "\n".join(f"{line(9)} *#*#" for _ in range(12)),
        "lines": "\n".join([*["ab cd"] * 20, *[line(30) for _ in range(10)]]),
        "words": "\n".join([f"{line(1)} {passage}", f"{passage} {line(1)}", *[line() for _ in range(7)]]),
    }
    twice = "\n".join([*(lines := [line() for _ in range(11)]), lines[3]])
    groups = [("large", 60), ("small", 4)]
    rows, names = [], {}
    for source, size in groups:
        for text, name in [*((document(), "plain") for _ in range(size)), (twice, "twice"), *((v, k) for k, v in junk.items())]:
            names[len(rows)] = (source, name)
            rows.append((len(rows), text, "en", source))
    names[len(rows)] = ("alone", "symbols")
    rows.append((len(rows), junk["symbols"], "xx", "alone"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    judged = quality.judge_documents(spark, docs).collect()
    assert not any(r.base_failed for r in judged)
    wrong = [names[r.doc_id] for r in judged if r.kept != (names[r.doc_id][1] in ("plain", "twice"))]
    assert wrong == []


def test_quality_messy(spark, messy, nothing):
    rows = quality.judge_documents(spark, messy).collect()
    assert len(rows) == messy.count()
    assert all(r.n_words == 0 and r.base_failed for r in rows if r.doc_id in (4, 5, 6))
    assert quality.judge_documents(spark, nothing).count() == 0
    kept = quality.keep_good_documents(spark, messy)
    assert kept.columns == messy.columns and {r.n_words for r in kept.collect()} == {7}


def plain_pii(text):
    """Per kind by the patterns as they are written in the contract."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, digits[::-1])))
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and total % 10 == 0)
                or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def test_pii(spark, sf_dir, corpus):
    for r in queries.op3_private_data(spark, sf_dir).collect():
        base = plain_pii(corpus[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))
        assert r.n_email == sum(x.startswith("email") for x in base)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e @x.y a@@b.c a@b.c.d. x@y z@q-.-r",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 9999.1.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111114111 1 2",
        "+1 (212) 555-0199 +12 ++49 30 1234567890 +1((((((((",
        "é@ü.com ä+1 212 555 0199é +" + "1" * 40,
    ],
)
def test_pii_edges(text):
    base = sorted(pii.base_spans(text), key=lambda s: (s[1], pii.KINDS.index(s[0])))
    assert [f"{k}:{s}:{e}" for k, s, e in base] == plain_pii(text)


def test_pii_messy(spark, messy, nothing):
    rows = pii.digest(pii.find_pii(spark, messy)).collect()
    assert len(rows) == messy.count()
    assert next(r.n_phone for r in rows if r.doc_id == 9) == 1
    clean = {r.doc_id: r.text for r in pii.redact(spark, messy).collect()}
    assert clean[9] == "mail [EMAIL] or [PHONE], ip [IP]." and clean[4] is None and clean[8] == "one"
    assert pii.find_pii(spark, nothing).count() == 0 and pii.redact(spark, nothing).count() == 0


def test_pii_takes_whole_tokens():
    def cut(text, kind):
        return [text[s:e] for k, s, e, *_ in pii.candidate_spans(text) if k == kind]

    long, jwt = "aB3" * 100, f"{'eyJhb9' * 5}.{'eyJzd2' * 9}.{'Sfl_-8' * 7}"
    for secret in (long, jwt, "p@ss!w0rd$#1x", "it's4secret!"):
        assert cut(f"the token: {secret} and more", "secret") == [secret]
        assert cut(f"password={secret}", "secret") == [secret]
    assert cut(f"token = '{jwt}', next", "secret") == [jwt]
    assert cut('secret: "four words 2 keep", next', "secret") == ["four words 2 keep"]
    assert cut('token="abc","user":"somebody else"', "secret") == []
    assert cut("api_key: abcd1234efgh. Then", "secret") == ["abcd1234efgh"]
    for mail in (f"{'a1.' * 40}b (at) site.org", "bob [at] a.b.c.d.e.f.org", f"bob (at) {'x' * 70}.org"):
        assert cut(f"write to {mail} now", "email") == [mail]


def test_pii_learns_from_all_votes():
    counts = Counter({"secret:-yyyy:5": 90, "secret:-ynny:4": 10, "secret:-yn-n:4": 40, "email:y-y--:5": 50})
    accepted = pii.accepted_patterns(counts)
    assert "secret:-yyyy:5" in accepted and "secret:-yn-n:4" not in accepted


def test_licenses(spark, messy, nothing):
    rows = [
        (1, "Text here.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"),
        (2, "Released under the MIT License. And more! Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0,MIT"),
        (3, "nothing licensed here", ""),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs).collect()}
    assert got == {r[0]: r[2] for r in rows}
    assert licenses.scan_licenses(messy).count() == messy.count()
    assert licenses.scan_licenses(nothing).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD_TEXT = """Copyright (c) 2020, A. Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAME = """3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL_TEXT = """Frobnicate is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
LGPL_TEXT = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_whole_wrapped_licenses(spark):
    commented = "/*\n" + "".join(f" * {x}\n" if x else " *\n" for x in MIT_TEXT.split("\n")) + " */\ncode();"
    rows = [
        (1, MIT_TEXT, "MIT"),
        (2, BSD_TEXT, "BSD-2-Clause"),
        (3, BSD_TEXT + BSD_NAME.format("the copyright holder"), "BSD-3-Clause"),
        (4, BSD_TEXT + BSD_NAME.format("the University of Nowhere"), "BSD-3-Clause"),
        (5, BSD_TEXT + BSD_NAME.format("Somebody Inc."), "BSD-3-Clause"),
        (6, APACHE_TEXT, "Apache-2.0"),
        (7, GPL_TEXT, "GPL-3.0-or-later"),
        (8, LGPL_TEXT, "LGPL-2.1-or-later"),
        (9, ISC_TEXT, "ISC"),
        (10, MPL_TEXT, "MPL-2.0"),
        (11, commented, "MIT"),
        (12, MIT_TEXT.replace("\n", "\r\n"), "MIT"),
        (13, " ".join(MIT_TEXT[MIT_TEXT.index("Permission") :].split()), "MIT"),
        (14, "no end of a line***\nReleased under the MIT License\nand more", "MIT"),
        (15, MIT_TEXT.replace("free of charge", "for a fee"), ""),
        (16, "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert {k: r.licenses for k, r in got.items()} == {r[0]: r[2] for r in rows}
    assert got[6].sequence == "apache-short apache-comply apache-copy apache-as-is"


def test_mixing_targets(spark):
    rows = [("a", 100), ("b", 1), ("c", 50), (None, 10), ("d", 0)]
    sizes = spark.createDataFrame(rows, "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(spark, sizes).collect()}
    size, order = dict(rows), ["a", "b", "c", "d", None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:  # as the contract says it
        rest = sum(size.values()) - sum(3 * size[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in order:
        assert got[s] == pytest.approx(3 * size[s] if s in capped else share[s])


def test_mixing(spark, messy, nothing):
    a, b = (sorted(mixing.plan_mix(spark, messy).select("doc_id", "size", "taken").na.fill(-1).collect()) for _ in "ab")
    assert a == b and len(a) == messy.count() and all(r.taken <= 3 * r["size"] for r in a)
    mixed = mixing.mix_documents(spark, messy)
    assert mixed.columns == messy.columns
    taken = sum(r.taken for r in a)
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == taken
    assert mixing.plan_mix(spark, nothing).count() == 0 and mixing.mix_documents(spark, nothing).count() == 0


def check_packing(pieces, placed, expected):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    ids = {(r.part, r.length, r.nth): bytes(r.ids) for r in pieces.collect()}
    for r in placed.collect():
        assert zlib.crc32(ids[r.part, r.length, r.nth]) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.length, ids[r.part, r.length, r.nth]))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, want in expected.items():
        assert b"".join(x[2] for x in sorted(by_doc[doc])) == want
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return sum(r[1] for p in by_sequence.values() for r in p) / max(1, len(by_sequence) * packing.WINDOW)


def test_packing(spark, sf_dir, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = {
        i: np.asarray([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in corpus.items()
    }
    pieces, placed = packing.pack_documents(spark, table(spark, sf_dir, "documents"))
    assert check_packing(pieces, placed, want) > 0.95
    sequences = packing.read_sequences(pieces, placed).collect()
    assert all(len(r.ids) == 4 * r.length for r in sequences)


def test_packing_messy(spark, messy, nothing):
    pieces, placed = packing.pack_documents(spark, messy)
    assert {(r.doc_id, r.doc_tokens) for r in placed.collect() if r.doc_id in (4, 5, 6)} == {(4, 1), (5, 1), (6, 1)}
    _, placed = packing.pack_documents(spark, nothing)
    assert placed.count() == 0


def test_repeats(spark, sf_dir, corpus):
    seen, want = set(), {}
    for i in sorted(corpus):
        words = WORD.findall(corpus[i])
        windows = [tuple(words[p : p + 50]) for p in range(len(words) - 49)]
        gone = {q for p, w in enumerate(windows) if w in seen for q in range(p, p + 50)}
        seen.update(windows)
        want[i] = (len(words), len(gone), " ".join(w for q, w in enumerate(words) if q not in gone))
    got = repeats.remove_repeats(spark, table(spark, sf_dir, "documents")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want


def test_repeats_messy(spark, messy, nothing):
    rows = [(r.doc_id, r.n_words, r.n_removed) for r in repeats.remove_repeats(spark, messy).collect()]
    assert len(rows) == messy.count()
    assert (1, 160, 0) in rows and rows.count((2, 160, 160)) == 2 and (None, 160, 0) in rows
    assert (4, 0, 0) in rows and (3, 160, 159) in rows
    assert repeats.remove_repeats(spark, nothing).count() == 0


def weighted_classes(texts):
    """Classes by plain Python: shingles as tuples of words, exact frequencies, all pairs."""
    bags = {}
    for i, text in texts.items():
        words = WORD.findall(text)
        if words:
            size = min(5, len(words))
            bags[i] = Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    df = Counter(s for bag in bags.values() for s in bag)
    n = len(bags)
    weights = {i: {s: tf * math.log(1 + n / max(df[s], n / 256)) for s, tf in bag.items()} for i, bag in bags.items()}
    totals = {i: sum(w.values()) for i, w in weights.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            both = sum(min(w, weights[b][s]) for s, w in weights[a].items() if s in weights[b])
            if both >= 0.8 * (totals[a] + totals[b] - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in texts}


def test_near_copies(spark, sf_dir, corpus):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r.class_id for r in near_copies.near_copy_classes(spark, docs).collect()}
    assert got == weighted_classes(corpus)


def planted(n_plain):
    """Copies with one stretch of words changed, so that similarities lie on both sides of 0.8,
    and a common passage in every document."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = {}
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(200)]
        for k in range(6):
            words, changed = list(base), int(rng.integers(5, 35))
            words[50 : 50 + changed] = [f"g{group}k{k}x{i}" for i in range(changed)]
            texts[100 * group + k] = " ".join(words) + " " + passage
    for i in range(n_plain):
        texts[10_000 + i] = " ".join(f"p{i}w{j}" for j in range(60)) + " " + passage
    return texts


@pytest.mark.parametrize("n_plain", [20, 700])
def test_planted_near_copies(spark, n_plain, monkeypatch):
    monkeypatch.setattr(near_copies, "PARTNERS", 2)
    texts = planted(n_plain)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    got = {r.doc_id: r.class_id for r in near_copies.near_copy_classes(spark, docs).collect()}
    assert got == weighted_classes(texts)
    assert 1 < len({c for i, c in got.items() if i < 10_000}) < 72


def test_exact_frequencies(spark):
    """The frequencies of common shingles are exact, at any number of documents."""
    texts = [f"a b c d e {' '.join(f'x{i}y{k}' for k in range(40))}" + (" p q r s t" if i % 3 else "") for i in range(900)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    n, (own, df) = near_copies.document_frequencies(spark, docs)
    known = dict(zip(own.tolist(), df.tolist()))
    common, some = (near_copies.shingles(near_copies.word_hashes(t))[0] for t in ("a b c d e", "p q r s t"))
    assert n == 900 and known == {int(common): 900, int(some): 600}
    weights = dict(zip(own.tolist(), near_copies.idf_table(n, (own, df))[1].tolist()))
    assert weights[int(some)] == pytest.approx(math.log(1 + 900 / 600) / math.log(257))


def test_word_hashes():
    words = ["one", "", "two", "one", "x" * 70_000, "é", "one"]
    hashes = near_copies.word_hashes(" \t".join(words) + "\n").tolist()
    assert len(hashes) == 6 and hashes[0] == hashes[2] == hashes[5] and len(set(hashes)) == 4
    long = " ".join(f"w{i}" for i in range(400_000))
    whole = near_copies.word_hashes(long)
    assert len(np.unique(whole)) == len(whole) == 400_000
    assert whole[-1] == near_copies.word_hashes("w399999")[0]


def test_near_copies_in_one_bucket_group(spark):
    """A chain of copies: neighbours are alike, the ends are not; one class results."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 400)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        at = rng.integers(0, 400)
        words[at : at + 5] = [f"n{i}{k}" for k in range(len(words[at : at + 5]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.class_id for r in near_copies.near_copy_classes(spark, docs).collect()} == {0}


def copies_without_links(n):
    """Copies of a text that is no document, each with two words of its own: most meet in buckets,
    no two are alike."""
    rng = np.random.default_rng(5)
    texts = {}
    for i in range(n):
        words = [f"base{k}" for k in range(150)]
        at = int(rng.integers(10, 138))
        words[at], words[at + 2] = f"own{i}", f"other{i}"
        texts[i] = " ".join(words)
    for i in range(4 * n):
        texts[10_000 + i] = " ".join(f"p{i}w{j}" for j in range(6))
    return texts


@pytest.mark.parametrize("n", [40, 120])
def test_near_copies_compare_few_pairs(spark, monkeypatch, n):
    """The pairs to compare grow with the members of a group, not with their square."""
    staged = {}

    def counted(session, frame, name):
        staged[name] = near_copies_stage(session, frame, name)
        return staged[name]

    near_copies_stage = near_copies.stage
    monkeypatch.setattr(near_copies, "stage", counted)
    texts = copies_without_links(n)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in near_copies.near_copy_classes(spark, docs).collect()}
    assert got == weighted_classes(texts)
    assert staged["near-open"].select("id").distinct().count() > n // 2
    assert staged["near-cross"].count() <= n


def test_near_copies_messy(spark, messy, nothing):
    rows = [(r.doc_id, r.class_id) for r in near_copies.near_copy_classes(spark, messy).collect()]
    assert len(rows) == messy.count()
    assert rows.count((2, 1)) == 2 and (3, 1) in rows and (None, None) in rows and (4, 4) in rows and (5, 5) in rows
    kept = near_copies.keep_one_of_each(spark, messy)
    assert kept.columns == messy.columns
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 4, 5, 6, 7, 8, 9]
    assert near_copies.near_copy_classes(spark, nothing).count() == 0


@pytest.mark.parametrize("weight", [1.0, 2.0, 0.37])
def test_samples_estimate_similarity(weight):
    rng = np.random.default_rng(5)
    estimates = []
    for _ in range(60):
        own = rng.permutation(np.unique(rng.integers(0, 2**63, 700, dtype=np.uint64)))
        a, b = np.sort(own[:600]), np.sort(own[100:700])
        # half of the shared ones weigh more in b
        wa, wb = (np.full(len(x), weight, np.float32) for x in (a, b))
        wb[: len(b) // 2] *= 1.5
        agree = (near_copies.samples(a, wa) == near_copies.samples(b, wb)).mean()
        estimates.append(agree - near_copies.similarity((a, wa), (b, wb)))
    assert abs(np.mean(estimates)) < 0.03


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(spark, step(spark, docs, sf_dir), name)
        assert docs.columns == columns
        if name != "mixing":
            assert 0 < docs.count() <= before
            before = docs.count()
        if name == "private_data":
            assert docs.filter(F.col("text").rlike(r"[A-Za-z0-9]+@[A-Za-z0-9-]+\.[A-Za-z]+")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.agg(F.sum("length")).first()[0] > 0


def test_pipeline_on_nothing(spark, sf_dir, nothing):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents").filter("false")
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(spark, step(spark, docs, sf_dir), name)
    assert docs.count() == 0


def test_packing_words():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer, known = Tokenizer.from_file(path), packing.WordIds(path)
    words = ["", "...", "Ab.", "Übel,", "bNİ.", "क़.", "it's", "<|endoftext|>", "x<y", "ΣΑΣ.", "a1", "éa!", "µ", "z" * 60 + "?"]
    for _ in range(2):
        known.learn(set(words))
        for w in words:
            ids = tokenizer.encode(w, add_special_tokens=False).ids
            assert known.ids[w] == np.asarray(ids, "<u4").tobytes(), w


def test_keys_only_where_ids_repeat(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (2, "c"), (None, "d"), (None, "e"), (3, None)], "id bigint, text string")
    keys = {(r.id, r.text): r.key for r in repeats._keyed(spark, d).collect()}
    assert len(keys) == 6 and keys[2, "b"] != keys[2, "c"] and 0 not in (keys[2, "b"], keys[2, "c"])
    assert {k for (i, _), k in keys.items() if i != 2} == {0}
