"""Language identification, phrases and the manifest against brute force, on awkward rows and on an empty table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import helpers
import numpy as np
import pytest
from paths import SF_MID
from pyspark.sql import functions as F

from lakebank.llm import langid, manifest, phrases


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    return helpers.folder(spark, tmp_path_factory.mktemp("docs"))


@pytest.mark.parametrize("query", [langid.op11_ppm_language, phrases.op12_collocations, manifest.op13_merkle_manifest], ids=lambda q: q.__name__)
def test_empty_table(spark, tmp_path, query):
    assert query(spark, helpers.folder(spark, tmp_path, [])).collect() == []


# -- language identification ------------------------------------------------------------------------------------------

class Trees:
    """The same model by dictionaries, one byte at a time."""

    def __init__(self, chunks):
        self.after = defaultdict(Counter)
        for c in chunks:
            for i in range(langid.ORDER, len(c)):
                for k in range(langid.ORDER + 1):
                    self.after[c[i - k:i]][c[i]] += 1

    def prob(self, context, byte):
        shorter = (lambda b: self.prob(context[1:], b)) if context else (lambda b: 1 / 256)
        seen = self.after.get(context)
        if not seen:
            return shorter(byte)
        total, distinct = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (total + distinct)
        return distinct / (total + distinct) / (1 - sum(shorter(b) for b in seen)) * shorter(byte)


CHUNKS = {"x": [b"abracadabra abba", b"cab"], "y": [b"bananas and nabobs"], "z": [b""]}


def test_code_lengths_are_those_of_the_context_trees():
    model = langid.Model(CHUNKS)
    texts = [langid.normalised(t) for t in ("abba cab", "ban", "", "q?é", "a")]
    got = model.code_lengths(texts)
    for lang, j in zip(model.langs, range(3)):
        tree = Trees(CHUNKS[lang])
        for raw, cost in zip(texts, got[:, j]):
            want = sum(-math.log2(tree.prob(raw[i - langid.ORDER:i], raw[i])) for i in range(langid.ORDER, len(raw)))
            assert cost / langid.UNIT == pytest.approx(want, abs=len(raw) * (langid.ORDER + 2) / langid.UNIT)


def test_probabilities_of_all_bytes_sum_to_one():
    model = langid.Model(CHUNKS)
    for context in (b"abra", b"zzzz", b"cada", b"nana"):
        keys = langid.windows(np.frombuffer(b"".join(context + bytes([b]) for b in range(256)), np.uint8))[::langid.ORDER + 1]
        assert (2.0 ** (-model.cost(keys) / langid.UNIT)).sum(0) == pytest.approx(1, abs=1e-2)


def test_long_texts_are_scored_in_parts(monkeypatch):
    model = langid.Model(CHUNKS)
    texts = [langid.normalised(t) for t in ("abracadabra " * 2000, "", "bananas" * 1000, "")]
    whole = model.code_lengths(texts).tolist()
    monkeypatch.setattr(langid, "STEP", 1)
    assert model.code_lengths(texts).tolist() == whole


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = {r.doc_id: r for r in langid.op11_ppm_language(spark, SF_MID).collect()}
    rows = docs.collect()
    assert len(out) == len(rows)
    assert all(out[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [out[r.doc_id].lang_pred == r.lang for r in rows if out[r.doc_id].held_out and r.lang is not None]
    assert len(judged) > 100 and sum(judged) >= 0.98 * len(judged)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_of_awkward_rows(spark, sf):
    rows = langid.op11_ppm_language(spark, sf).collect()
    docs = helpers.documents()
    assert len(rows) == len(docs)
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in docs)
    letters = {r[0]: any(map(str.isalpha, r[1] or "")) for r in docs}
    assert all((r.lang_pred == ("en" if letters[r.doc_id] else "und")) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_prediction_does_not_look_at_held_out_labels(spark):
    text = {"aa": "ab ba abab baba " * 20, "bb": "xy yx xyxy yxyx " * 20}
    rows = [(i, text["aa" if i % 2 else "bb"], "aa" if i % 2 else "bb") for i in range(40)]
    # held-out documents carry a language of their own: it must not be learnt
    rows = [(i, t, "cc" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.predict(docs, langid.Model(langid.training_chunks(docs))).collect()
    assert {(r.doc_id % 2, r.lang_pred) for r in out} == {(1, "aa"), (0, "bb")}


# -- phrases ----------------------------------------------------------------------------------------------------------

def phrase_rows(docs, longest, least, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        big = {p: n for p, n in counts.items() if len(p) > 1 and n >= least}
        inner = Counter()
        for p, n in big.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner[p[i:i + size]] = max(inner[p[i:i + size]], n)
        rows = []
        for p, a in big.items():
            if inner[p] < a:
                score, _, left, right = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((" ".join(p), a, left, right, total[lang], score))
        rows.sort(key=lambda r: (-r[-1], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("longest, least, top", [(5, 2, 2000), (5, 3, 4), (3, 1, 2000), (2, 2, 5)])
def test_phrases(spark, longest, least, top):
    rng = random.Random(longest)
    vocab = ["a", "B", "the", "é", "ß", "|", "a'b", "\x00", "of"]
    docs = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  ", ", "]) for _ in range(rng.randint(0, 60)))) for _ in range(80)]
    docs += [("en", None), ("en", ""), ("fr", " . \n"), ("en", "the of the of the of")] + [("en", "to be or not to be that is")] * 7
    out = phrases.collocations(spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, n long, phrase string"), longest, least, top)
    assert sorted(tuple(r) for r in out.collect()) == phrase_rows(docs, longest, least, top)


def test_phrases_of_awkward_rows_and_small_batches(spark, sf, monkeypatch):
    monkeypatch.setattr(phrases, "HELD_BYTES", 100)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = phrase_rows([(r[2], r[1]) for r in helpers.documents()], 5, 2, 2000)
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=2).collect()) == want


def test_scores_beyond_64_bits(spark):
    big = 10**13
    row = spark.range(1).select(F.lit(big).alias("a"), F.lit(9 * big).alias("total"), F.lit(big).alias("l"), F.lit(big + 1).alias("r"))
    score = "(1000 * cast(a as decimal(19, 0)) * cast(total as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    assert row.selectExpr(score).head()[0] == 1000 * big * 9 * big // (big * (big + 1))


def test_filter_keeps_every_frequent_phrase(spark):
    rng = random.Random(1)
    docs = [("en", " ".join(rng.choice("abcdefghij") for _ in range(50))) for _ in range(30)] + [("de", "é ß " * 40)]
    level = phrases.read_level(spark.createDataFrame(docs, "lang string, text string").repartition(3), 1, None, True)
    keep = phrases.bucket_filter(level, 20)
    hashes = phrases.WordHashes()
    count = Counter((lang, pair) for lang, text in docs for pair in zip(text.split(), text.split()[1:]))
    let = 0
    for (lang, pair), n in count.items():
        h, whole = phrases.grams(lang, np.array([1, 2]), np.array([0, *(hashes[w.encode()] for w in pair)], np.uint64), 2, hashes)
        held = bool(phrases.passes(keep, h)[0])
        assert whole.all() and (held or n < 20)
        let += held
    assert sum(n >= 20 for n in count.values()) <= let < len(count)


# -- manifest ---------------------------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def build(level, fan):
    """Root of the digests, and per digest the (before, after) of every level."""
    paths, spots = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, s in zip(paths, spots):
            a = s // fan * fan
            path.append((level[a:s], level[s + 1:a + fan]))
        spots = [s // fan for s in spots]
        level = [sha(*level[i:i + fan]) for i in range(0, len(level), fan)]
    return level[0], paths


def manifest_rows(rows, fan):
    rows = [tuple(r[:5]) for r in rows]
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append(build([leaf_of(r) for r in by[s]], fan))
    root, upper = build([t[0] for t in trees], fan)
    out = []
    for s, (subroot, paths), above in zip(sources, trees, upper):
        for r, path in zip(by[s], paths):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            fold = leaf_of(r, tampered)
            for left, right in path + above:
                fold = sha(*left, fold, *right)
            out.append((r[0], leaf_of(r), subroot, root, sha(*[x for a, b in path + above for x in a + b]), fold, fold == root))
    return Counter(out)


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_manifest(spark, sf, fan):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, manifest.leaf_digest(text=manifest.ascii_lower(F.col("text"))))
    assert Counter(tuple(r) for r in manifest.manifest(docs, altered, fan).collect()) == manifest_rows(helpers.documents(), fan)


def test_manifest_of_many_small_and_one_large_source(spark):
    rows = [(i, f"Text {i}", None, "big" if i % 3 else f"s{i}", i) for i in range(700)] + [(700, "Alone", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, manifest.leaf_digest(text=manifest.ascii_lower(F.col("text"))))
    for fan in (2, 16):
        assert Counter(tuple(r) for r in manifest.manifest(docs, altered, fan).collect()) == manifest_rows(rows, fan)


def test_manifest_of_one_document(spark):
    docs = spark.createDataFrame([(4, "ABC", None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = manifest.manifest(docs, F.lit(None).cast("string")).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf_of((4, "ABC", None, None, 3)) and row.verified
    assert row.proof_sha256 == sha()
