"""Operators on documents against brute force, on awkward rows and on an empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import helpers
import pytest

from lakebank.llm import common, licenses, mixing, neardup, pii, quality, sharding, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    return helpers.folder(spark, tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return helpers.folder(spark, tmp_path_factory.mktemp("none"), [])


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def texts():
    return [(r[0], r[1]) for r in helpers.documents()]


QUERIES = [quality.op1_line_quality, pii.op2_context_pii, tokens.op3_bpe, licenses.op6_license_signatures, mixing.op7_mix_sources,
           neardup.op8_superminhash, sharding.op9_kd_shards]


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.__name__)
def test_empty_table(spark, empty, query):
    assert query(spark, empty).collect() == []


def base_quality(text):
    text = text or ""
    found = WORD.findall(text)
    grams = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
    count = Counter(grams)
    marked = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n")]
    dups = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    n = len(found)
    return n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dups, len(marked), n < 10 or 100 * len(marked) > 20 * n


def test_quality_counts(spark, sf):
    out = quality.op1_line_quality(spark, sf)
    got = rows_of(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    assert got == Counter((i, *base_quality(t)) for i, t in texts())
    assert out.where("base_failed and kept").count() == 0


def test_quality_viterbi_is_the_best_path():
    import itertools
    import random

    rng = random.Random(1)
    for _ in range(30):
        n = rng.randint(1, 6)
        feats = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(n)]
        emit, move, start = [rng.gauss(0, 1) for _ in range(3)], [[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)], [rng.gauss(0, 1) for _ in range(2)]

        def score(path):
            s = [sum(a * b for a, b in zip(f, emit)) for f in feats]
            return start[path[0]] + sum(s[i] for i, y in enumerate(path) if y) + sum(move[a][b] for a, b in zip(path, path[1:]))

        assert tuple(quality.viterbi(feats, (emit, move, start))) == max(itertools.product((0, 1), repeat=n), key=score)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights = quality.train(docs.where("doc_id % 2 = 0"), labels)
    seen = quality.judge(docs.where("doc_id % 2 = 1"), weights).join(labels, "doc_id").where("not base_failed")
    right, n = seen.selectExpr("avg(double(kept = (quality = 1)))", "count(*)").head()
    assert n > 100 and right > 0.97


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out, counts = [], []
    for kind, pattern in PATTERNS:
        spans = []
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                spans.append(f"{kind}:{m.start()}:{m.end()}")
        out += spans
        counts.append(len(spans))
    return *counts, hashlib.sha256(",".join(out).encode()).hexdigest()


def test_pii_base(spark, tmp_path):
    import random

    rng = random.Random(3)
    odd = ["".join(rng.choice("0123456789 -+.@ab()é\n") for _ in range(300)) for _ in range(150)]
    odd += ["a" * 30_000, "1 " * 5_000, "+1" * 2_000, "a@b.c" * 500, "1.2.3.4." * 500, "a@" + "b." * 3_000 + "c", "😀 4111-1111-1111-1111 é x@y.z_q@r.st", None, ""]
    rows = [(i, t) for i, t in enumerate(odd)] + texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(pii.find(df).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"))
    assert got == Counter((i, *base_spans(t)) for i, t in rows)


def test_pii_contexts_reveal_unseen_identifiers(spark):
    known = [(i, f"please write to our desk mail {i}x@mail{i}.org for help") for i in range(30)]
    unseen = [(100 + i, f"please write to our desk mail user{i}123(at)mail.org for help") for i in range(3)]
    clean = [(200 + i, f"the year {1990 + i}77 was calm and order 12345{i} is shipped") for i in range(30)]
    df = spark.createDataFrame([*known, *unseen, *clean], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert all(got[i].n_discovered == 0 and got[i].n_email == 1 for i, _ in known)
    assert [got[i].spans for i, _ in unseen] == ["email:30:38"] * 3
    assert all(got[i].spans == "" for i, _ in clean)
    assert "[EMAIL]" in pii.redact(df).where("doc_id = 101").head().text


def test_pii_reveals_identifiers_of_any_form(spark):
    digits = lambda i, n: str(10**20 + i * 7919**3)[-n:]
    known = [(i, f"call the customer phone number: +1 555 01{i:02d} 22{i:02d} before noon") for i in range(40)]
    known += [(100 + i, f"his secret card number is 4111-1111-1111-1111 or {i} more, charged to card no {luhn_card(i)} today") for i in range(40)]
    known += [(200 + i, f"the server has address {10 + i}.1.2.{i} on the wire, from host {10 + i}.1.2.{i} again") for i in range(40)]
    known += [(300 + i, f"write a letter to u{i}@mail{i}.org this week") for i in range(40)]
    odd = {1000: ("call the customer phone number: 555 010 2222 before noon", "phone", "555 010 2222"), 1001: ("call the customer phone number: (555) 010-2224 before noon", "phone", "(555) 010-2224"),
           1002: ("the server has address 300.1.2.3.4 on the wire", "ip", "300.1.2.3.4"), 1003: ("write a letter to jörg.müller@büro this week", "email", "jörg.müller@büro"),
           1004: ("write a letter to " + "x" * 90 + "7 this week", "email", "x" * 90 + "7"), 1005: (f"charged to card no 4111 1111 1111 1112 today", "card", "4111 1111 1111 1112")}
    clean = [(2000 + i, f"the year {1990 + i} was calm and order {digits(i, 9)} is shipped") for i in range(30)]
    df = spark.createDataFrame([*known, *clean, *((i, t) for i, (t, _, _) in odd.items())], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    for i, (text, kind, value) in odd.items():
        assert f"{kind}:{text.index(value)}:{text.index(value) + len(value)}" in got[i].spans.split(","), (text, got[i])
    assert all(got[i].n_discovered == 0 for i, _ in clean)


def luhn_card(i):
    body = f"4{i:014d}"
    return next(body + str(c) for c in range(10) if luhn(body + str(c)))


def test_pii_many_matches_in_one_text(spark):
    import time

    rows = [(1, " ".join(f"u{i}@mail.org" for i in range(30_000))), (2, " ".join(f"{i}1234 x" for i in range(30_000))), (3, " +1 222 5550000;" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    pii.find(df.limit(0)).collect()
    begin = time.monotonic()
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert (got[1].n_email, got[3].n_phone) == (30_000, 20_000)
    assert got[1].base_sha256 == base_spans(rows[0][1])[-1]
    assert time.monotonic() - begin < 60


def test_pii_redaction_keeps_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = pii.stage_pii(spark, docs, sf)
    assert out.columns == docs.columns and out.count() == docs.count()
    by_id = {r.doc_id: r.text for r in out.collect()}
    assert by_id[0] is None and by_id[1] == ""
    assert by_id[19] == "mail me at [EMAIL] or [PHONE] now"
    assert by_id[20] == "[CARD] and [IP] and 10.0.0.256"


def tiktoken_encoding():
    import tiktoken

    path, pattern = tokens.vocabulary()
    ranks = tokens.parse_ranks(tokens.read_ranks(path))
    return ranks, pattern, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_bpe_documents(spark, sf):
    _, _, enc = tiktoken_encoding()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter((i, len(x := enc.encode_ordinary(t or "")), sha(",".join(map(str, x)).encode()), sha((t or "").encode())) for i, t in texts())
    assert rows_of(tokens.op3_bpe(spark, sf)) == want


def test_bpe_odd_texts():
    import random

    ranks, pattern, enc = tiktoken_encoding()
    rng = random.Random(0)
    coder = tokens.Bpe(ranks, pattern)
    odd = ["", "a" * 50_000, "ab" * 3_000, " " * 3_000, "\n" * 999 + "x", "é" * 999, "<|endoftext|>", "a\x00b", " don't"]
    odd += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (127, 128, 129, 130, 4_000)]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF)])) for _ in range(200)) for _ in range(60)]
    got = coder.encode(odd)
    assert got == [enc.encode_ordinary(x) for x in odd]
    assert [coder.decode(x) for x in got] == [x.encode() for x in odd]


def license_row(text):
    """Every rule on every text, every pair of detections compared."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    listed = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    line = f" {' '.join(listed)} "
    base = sorted((line.count(" ", 0, m.start()) - 1, label) for phrase, label in licenses.PHRASES.items() for m in re.finditer(f"(?<= ){phrase}(?= )", line))
    hits = sorted({(m.start(), -m.end(), r.tier, r.order, r.label) for r in licenses.rules() for m in re.finditer(r.pattern, line)})
    kept = [h for i, h in enumerate(hits) if not any(g[1] <= h[1] and g[2] <= h[2] for g in hits[:i])]
    tiers = [h[2] for h in kept] + [2] * len(base)
    return (len(listed), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({b for _, b in base})),
            ",".join(sorted({h[4] for h in kept} | {b for _, b in base})), licenses.CONFIDENCE[min(tiers)] if tiers else 0.0)


def test_licenses(spark):
    odd = ["MIT License", "Under the\nMIT-License. CC BY-NC 4.0", "SPDX-License-Identifier: GPL-3.0-only", "licensed under the gnu general public license version 3",
           "é under the mit license é cc by nc é", "cc by nc " * 100, "under the mit license " * 200, "Copyright (c) 2020 X. All rights reserved.", "mit dem und mit der",
           "Redistribution and use in source and binary forms, with or without", "licensed under the Apache License, Version 2.0 (the License)", "cc by", "CC\tBY--NC"]
    rows = [(1000 + i, t) for i, t in enumerate(odd)] + texts()
    got = rows_of(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).drop("detections"))
    assert got == Counter((i, *license_row(t)) for i, t in rows)
    assert len(licenses.rules()) > 200


def samples(parts):
    """Texts that a parsed pattern matches: each alternative and both ends of each repeat, one change at a time."""
    outs = [""]
    for op, arg in parts:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "SUBPATTERN":
            some = samples(arg[3])
        elif name == "BRANCH":
            some = [x for branch in arg[1] for x in samples(branch)]
        elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT"):
            some = [x * n for n in sorted({arg[0], min(arg[1], arg[0] + 1)}) for x in samples(arg[2])]
        elif name == "IN":
            some = [chr(x if str(kind) == "LITERAL" else x[0]) for kind, x in arg[:1]]
        elif name in ("ASSERT", "ASSERT_NOT"):
            some = [""]
        else:
            raise ValueError(name)
        outs = [outs[0] + x for x in some] + [x + some[0] for x in outs[1:]]
    return list(dict.fromkeys(outs))


def test_license_gate_lets_all_rules_through(spark):
    short = ["This code is released under GPL v3", "Distributed under the LGPL 2.1.", "RELEASED\nUNDER CC0", "available under: MPL 2.0", "published  under GFDL"]
    rows = list(enumerate(short))
    got = rows_of(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).drop("detections"))
    assert got == Counter((i, *license_row(t)) for i, t in rows)
    assert [r[6] for r in sorted(got)] == ["gpl-3", "lgpl-2.1", "cc0-1", "mpl-2", "gfdl"]
    for rule in licenses.rules():
        for text in samples(re._parser.parse(rule.pattern)):
            assert re.search(rule.pattern, f" {text} ") and re.search(licenses.GATE, text), (rule.label, text)


def test_license_keywords_are_in_all_names(spark):
    rows = list(enumerate(["Licensed under the Expat License", "licensed under ELv2", "licensed under BSD-3-Clause-Clear", "Clear BSD license"]))
    got = rows_of(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).drop("detections"))
    assert got == Counter((i, *license_row(t)) for i, t in rows)
    assert [r[6] for r in sorted(got)] == ["mit", "elastic-2", "clear-bsd", "clear-bsd"]
    for rule in licenses.rules():
        for text in samples(re._parser.parse(rule.pattern)):
            assert any(k in text for k in rule.keywords), (rule.label, text)


def test_license_keywords_are_long_and_of_each_alternative(spark):
    assert all(len(k.strip()) >= 3 for rule in licenses.rules() for k in rule.keywords)
    assert licenses.alternatives("a(?:b|c)|d") == ["a(?:b|c)", "d"]
    assert licenses.literal("bsd (?:2|two) clause licen[cs]e") == " clause licen" and licenses.literal("non ?commercial(?: x)?") == "commercial"
    assert licenses.keywords("gnu gpl|gpl|mit") == ("gpl", "mit")
    assert licenses.keywords("mit|gpl ?2", " ", " licen") == (" mit licen", "gpl")
    for rule in licenses.rules():
        for text in samples(re._parser.parse(rule.pattern)):
            assert "cc" in text or any(w in text for w in licenses.GATE_WORDS), (rule.label, text)
    assert len(licenses.NOTICES) > 100 and len(licenses.rules()) > 300


def test_license_notices(spark):
    said = [("You may not use this file except in compliance with the License.", "apache-2"), ("Altered source versions must be plainly marked as such,", "zlib"),
            ("you think this stuff is worth it, you can buy me a beer", "beerware"), ("https://www.eclipse.org/legal/epl-v20.html", "epl-2"),
            ("Unauthorized copying of this file", "proprietary"), ("see opendatacommons.org/licenses/odbl/", "odbl"), ("a beer and a package, unmarked", ""),
            ("Permission is hereby granted, free of charge, to any person obtaining a copy of the Unicode data files", "unicode")]
    rows = list(enumerate(t for t, _ in said))
    got = rows_of(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).drop("detections"))
    assert got == Counter((i, *license_row(t)) for i, t in rows)
    assert [r[6] for r in sorted(got)] == [label for _, label in said]


def test_mix(spark, sf):
    got = mixing.op7_mix_sources(spark, sf).collect()
    rows = helpers.documents()
    assert len(got) == len(rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target = 1.5 * sum(size.values()), {}
    while True:
        free = [s for s in order if s not in target]
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
    by_size = defaultdict(set)
    for s in order:
        by_size[size[s]].add(target[s])
    taken, largest = Counter(), max(r.size for r in got)
    for r in got:
        assert r.target == pytest.approx(min(by_size[r.source_size], key=lambda t: abs(t - r.target)))
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size] += r.taken
    for n, total in taken.items():
        assert abs(total - sum(by_size[n])) <= largest
    assert rows_of(mixing.op7_mix_sources(spark, sf)) == Counter(tuple(r) for r in got)


def test_mix_of_equal_rows_meets_its_target(spark):
    df = spark.createDataFrame([(1, "s", "four words of text")] * 100 + [(2, "t", "a b c d")] * 50, "doc_id long, source string, text string")
    out = mixing.mix(df, [3, 1, 2])
    got = {r.source: r for r in out.groupBy("source").agg({"_mix_copies": "sum", "_mix_target": "max"}).collect()}
    for r in got.values():
        assert abs(4 * r["sum(_mix_copies)"] - r["max(_mix_target)"]) <= 4


def shingles(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def expected_groups(rows, width=3, percent=85):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = [i for i in sets if i is not None]
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return Counter((i, len(sets[i]), None if i is None else find(i), i is not None and find(i) == i) for i, _ in rows)


def test_near_duplicates(spark, sf):
    assert rows_of(neardup.op8_superminhash(spark, sf)) == expected_groups(texts())


def test_near_duplicates_in_a_large_group(spark):
    """Copies of one text with words changed: similarities lie on both sides of the limit, so chains matter."""
    import random

    rng = random.Random(9)
    base = helpers.words(rng, 150).split()
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(neardup.groups(df).drop("row", "group")) == expected_groups(rows)
    assert rows_of(neardup.groups(df, neardup.STAGE_RULE).drop("row", "group")) == expected_groups(rows, 5, 80)


@pytest.mark.parametrize("block, pivots", [(2048, 8), (7, 2), (40, 1)])
def test_near_duplicates_with_small_blocks(spark, monkeypatch, block, pivots):
    """Several chained groups that share buckets, cut into many blocks, with hardly any pivot: nothing is lost."""
    import random

    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "PIVOTS", pivots)
    rng = random.Random(block)
    base = helpers.words(rng, 120).split()
    rows = []
    for g in range(4):
        start = list(base)
        for k in range(g * 5):
            start[k * 5] = f"g{g}w{k}"
        for i in range(45):
            w = list(start)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            rows.append((1000 * g + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(neardup.groups(df).drop("row", "group")) == expected_groups(rows)


def test_near_duplicates_of_a_doc_id_with_two_texts(spark):
    import random

    rng = random.Random(4)
    a = helpers.words(rng, 200)
    b = a.split()
    b[100] = "changed"
    rows = [(1, helpers.words(rng, 150), "x"), (1, a, "y"), (2, " ".join(b), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.groups(df).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert sorted(r.source for r in neardup.stage_dedup(spark, df, "").collect()) == ["x", "y"]


def test_dedup_stage_takes_five_words_and_four_fifths(spark):
    import random

    rng = random.Random(6)
    w = helpers.words(rng, 200).split()
    rows = [(1, " ".join(w)), (2, " ".join(w[:166])), (3, " ".join(w[:150]))]      # 0.826 and 0.745 of the first's shingles; 0.90 of each other
    kept = neardup.stage_dedup(spark, spark.createDataFrame(rows[:2], "doc_id long, text string"), "").collect()
    assert [r.doc_id for r in kept] == [1]
    kept = neardup.stage_dedup(spark, spark.createDataFrame([rows[0], rows[2]], "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]


def test_superminhash_estimates_similarity_and_stops_exactly():
    import numpy as np

    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    errors = []
    for k in range(60):
        size = int(rng.integers(3, 900))
        a, b = pool[:size], np.r_[pool[size // 5:size], pool[size:size + size // 5]]
        sig = neardup.superminhash([a, b], 125)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append((sig[0] == sig[1]).mean() - true)
        assert (neardup.superminhash([a], 125)[0] == sig[0]).all()
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_dedup_stage_keeps_one_of_each_group(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = neardup.stage_dedup(spark, docs, sf)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    want = {i for i, _, _, k in expected_groups(texts(), 5, 80) if k}
    assert sorted(x for x in kept if x is not None) == sorted(want) and kept.count(None) == 2


@pytest.fixture
def shifting(spark, tmp_path, monkeypatch):
    """Documents in small files that every other scan splits in another way, as when executors come and go."""
    key = "spark.sql.files.minPartitionNum"
    rows = [(i, f"{t} {helpers.words(rng, 3)}" if i % 3 else t, "s") for rng in [random.Random(3)] for i in range(160) for t in [helpers.words(random.Random(i % 40), 80)]]
    rows += [(7, "equal rows of the one document", "s")] * 80
    for i in range(8):
        spark.createDataFrame(rows[i::8], "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    before, write = spark.conf.get(key, None), common.stored
    turns = iter(range(10**6))

    def stored(df, name):
        out = write(df, name)
        spark.conf.set(key, "64" if next(turns) % 2 == 0 else "1")
        return out

    spark.conf.set(key, "1")
    for module in (neardup, mixing, common):
        monkeypatch.setattr(module, "stored", stored)
    yield rows, spark.read.parquet(str(tmp_path / "docs"))
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_dedup_holds_when_scans_are_split_anew(spark, shifting):
    rows, docs = shifting
    rows = [r[:2] for r in rows if r[2] and r[0] != 7]
    docs = docs.where("doc_id <> 7")
    want = expected_groups(rows)
    assert rows_of(neardup.groups(docs).drop("row", "group")) == want
    assert sorted(r.doc_id for r in neardup.stage_dedup(spark, docs, "").collect()) == sorted(i for i, _, _, k in want if k)


def test_mix_of_equal_rows_when_scans_are_split_anew(spark, shifting):
    _, docs = shifting
    equal = docs.where("text = 'equal rows of the one document'")
    for share in (0.3, 0.55, 0.8):
        taken = sum(r["_mix_copies"] for r in mixing.mix(equal, [1], share, 2.0).collect())
        assert abs(taken - share * 80) <= 0.5


def test_kd_shards(spark, sf):
    got = sharding.op9_kd_shards(spark, sf).collect()
    rows = helpers.documents()
    data = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == Counter(
        (x[0], len(data(x[1])) + 8, zlib.crc32(data(x[1])), "bytes", None) for x in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(0 <= s < 24 and sorted(x) == list(range(len(x))) for s, x in slots.items())


def test_kd_cuts_are_near_equal_also_for_equal_rows(spark):
    df = spark.range(3000).selectExpr("case when id < 1000 then 7 else id end as doc_id", "cast(null as string) as lang", "'s' as source", "100L + id % 50 as size")
    got = sharding.kd_shards(df, "size", ["doc_id", "size", "lang", "source"], leaves=24).groupBy("_shard").sum("size").collect()
    total = sum(r[1] for r in got)
    assert len(got) == 24 and all(abs(r[1] - total / 24) < 500 for r in got)
    assert sharding.kd_shards(df, "size", ["doc_id"], target_bytes=total // 5 + 1).select("_shard").distinct().count() == 5


def test_kd_cuts_along_strings_with_a_common_beginning(spark):
    df = spark.range(2000).selectExpr("1 as flat", "case when id % 500 > 0 then concat('https://site_', lpad(id * 7919 % 500, 4, '0')) end as source", "100L as size")
    got = sharding.kd_shards(df, "size", ["flat", "source"], leaves=4).selectExpr("coalesce(source, '') as s", "_shard").groupBy("_shard").agg({"s": "array_agg"}).collect()
    spans = sorted((min(r[1]), max(r[1]), len(r[1])) for r in got)
    assert len(spans) == 4 and all(abs(n - 500) < 3 for *_, n in spans)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


GOOD = "The thing of the and that was with on in tion the hed anshi for are of that with and to the re. Ones are in the and then with that of the to a."


@pytest.fixture(scope="module")
def field(spark):
    sf = "/root/testdata/sf0.01"
    return quality.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


@pytest.mark.parametrize("junk", ["$$$ ### BUY!!! NOW!!! $$$ %%% ### &&&", "Home | About | Login"])
def test_only_junk_lines_about_good_ones_are_marked(field, junk):
    lines = [junk, *(f"{GOOD} {i}" for i in range(6)), junk]
    assert quality.viterbi(quality.line_table("\n".join(lines).encode())[0], field) == [0, 1, 1, 1, 1, 1, 1, 0]
    assert 0.8 < quality.judge_text("\n".join(lines), field, 0.5)[7] < 1


def test_line_labels_differ_within_documents(spark, field):
    out = quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), field).where("n_lines > 1")
    shares = [r.content_share for r in out.select("content_share").collect()]
    assert sum(0 < s < 1 for s in shares) >= 0.05 * len(shares)
    assert any(0 < s < 0.5 for s in shares) and any(0.5 <= s < 1 for s in shares)
    assert out.where("kept and n_content_lines < n_lines").count() > 0
    assert out.where("content_share < 0.5 and kept").count() == 0


def test_one_row_of_a_repeated_document_is_learnt_from(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", seen.extend)
    rows = [(7, f"some words of text number {i % 5}") for i in range(3000)] + [(i, f"line {i} of this") for i in range(8, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int"), 40)
    assert len(seen) == 13
