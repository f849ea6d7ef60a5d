"""Phrase collocations by stripes: every prefix keys a counter of the words that follow it."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakebank.llm.common import UPPER, pieces, stored, table
from lakebank.llm.neardup import WordHashes, mix

#: Longest phrase, least occurrences of a candidate, phrases reported per language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Hash buckets in which phrases are counted a level ahead, and the bits of the filter that comes
#: from them: bounds on what is counted and sent, whatever the input. They save work and decide nothing.
BUCKET_BITS, RANGE_BITS, FILTER_WORDS = 28, 16, 1 << 18
#: Bytes of text whose stripes a task merges before it sends them on.
HELD_BYTES = 8 << 20

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_STOP = bytes.maketrans(SEPARATORS + UPPER.encode(), b"." * len(SEPARATORS) + UPPER.lower().encode())


class Numbers(dict):
    """Words numbered from 1 in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_stream(texts: list[str | None]) -> list[bytes]:
    """Words of all texts in order, with ``.`` where a piece ends."""
    return b".".join((t or "").encode() for t in texts).translate(_STOP).replace(b".", b" . ").split()


def longer(hash_, word_hash):
    return mix(hash_ * np.uint64(0x9E3779B97F4A7C15) + word_hash)


def grams(lang: str, ids, of_word, k: int, hashes: WordHashes):
    """Hash of the ``k`` words from every place on, and whether they are words of one piece."""
    m = max(0, len(ids) - k + 1)
    h, whole = np.full(m, hashes[lang.encode()], np.uint64), np.ones(m, bool)
    for j in range(k):
        h, whole = longer(h, of_word[ids[j:m + j]]), whole & (ids[j:m + j] > 0)
    return h, whole


def passes(keep, h):
    """Whether the filter holds the bit of a hash (of the lowest bits of its bucket)."""
    return (keep[(h & np.uint64(FILTER_WORDS - 1)).astype(np.int64)] >> (h >> np.uint64(FILTER_WORDS.bit_length() - 1) & np.uint64(63)) & np.uint64(1)).astype(bool)


def read_part(lang: str, texts: list[str | None], k: int, keep, hashes: WordHashes):
    """One language's stripes of phrases of ``k`` words, and the hashes of phrases of one word more.

    Stripes are (prefix, next, n), one row per prefix of k - 1 words, or None. With ``keep`` (the filter of
    level k) only phrases that pass are counted, and only phrases hashed whose first and last k words pass.
    Words are told apart by numbers, not hashes, so counts are exact.
    """
    numbers = Numbers({b".": 0})
    words = word_stream(texts)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    names = pa.array(list(numbers), pa.binary()).cast(pa.string())
    of_word = np.fromiter((hashes[w] for w in numbers), np.uint64, len(numbers))
    h, passed = grams(lang, ids, of_word, k, hashes)
    if keep is not None:
        passed &= passes(keep, h)
    pos, v = np.flatnonzero(passed), len(numbers)
    ahead = pos[:-1][pos[1:] == pos[:-1] + 1]
    next_hashes = longer(h[ahead], of_word[ids[ahead + k]])
    if not len(pos):
        return None, next_hashes
    code = ids[pos]
    for j in range(1, k - 1):
        code = np.unique(code * v + ids[pos + j], return_inverse=True)[1]
    if k > 1:
        code = code * v + ids[pos + k - 1]
    both, first, n = np.unique(code, return_index=True, return_counts=True)
    pos = pos[first]
    at = np.flatnonzero(np.r_[True, both[1:] // v != both[:-1] // v])
    prefix = pc.binary_join_element_wise(*[names.take(pa.array(ids[pos[at] + j])) for j in range(k - 1)], " ") if k > 1 else pa.array([""])
    ends = pa.array(np.r_[at, len(pos)].astype(np.int32))
    return (prefix.cast(pa.string()), pa.ListArray.from_arrays(ends, names.take(pa.array(ids[pos + k - 1]))),
            pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int64)))), next_hashes


def bucket_rows(hashes):
    """Counts of the hashes' buckets as (range, places, counts): per range of buckets the touched places as uint16, and their counts (65,535 at most) as uint16."""
    bucket, n = np.unique(hashes & np.uint64((1 << BUCKET_BITS) - 1), return_counts=True)
    ranges = (bucket >> np.uint64(RANGE_BITS)).astype(np.int32)
    place = (bucket & np.uint64((1 << RANGE_BITS) - 1)).astype(np.uint16).tobytes()
    n = np.minimum(n, 65_535).astype(np.uint16).tobytes()
    cuts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]]) if len(ranges) else np.zeros(0, int)
    return [(r, place[2 * a:2 * b], n[2 * a:2 * b]) for r, a, b in zip(ranges[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(ranges)])]


LEVEL = "lang string, prefix string, next array<string>, n array<long>, range int, places binary, counts binary"


def read_level(texts: DataFrame, k: int, keep, ahead: bool, held_bytes: int | None = None) -> DataFrame:
    """Stripes of phrases of k words of (lang, text), merged over what a task holds at a time; with ``ahead`` also
    bucket counts of phrases of one word more, in rows of their own (lang null)."""
    bound = held_bytes or HELD_BYTES

    def run(batches):
        hashes = WordHashes()

        def flush(held):
            counted = []
            for lang, part in held.items():
                out, more = read_part(lang, part, k, keep, hashes)
                counted.append(more)
                if out:
                    m = len(out[0])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * m, pa.string()), *out, pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())], names=columns)
            rows = bucket_rows(np.concatenate(counted)) if ahead and counted else []
            for i in range(0, len(rows), 1024):
                r, places, counts = zip(*rows[i:i + 1024])
                empty = [pa.nulls(len(r), t) for t in (pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*empty, pa.array(r, pa.int32()), pa.array(places, pa.binary()), pa.array(counts, pa.binary())], names=columns)

        columns = ["lang", "prefix", "next", "n", "range", "places", "counts"]
        held: dict[str, list] = {}
        size = 0
        for batch in pieces(batches, 4096, 1, bound):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
            size += batch.column(1).nbytes
            if size >= bound:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)

    return texts.mapInArrow(run, LEVEL)


def merged(level: DataFrame) -> DataFrame:
    """Elementwise sums of the stripes: (lang, prefix, next, n), one row per element.

    A merged stripe is dealt out by (prefix, next), so that of a very common prefix lies on many tasks.
    """
    return (level.where("lang is not null").select("lang", "prefix", F.inline(F.arrays_zip("next", "n")))
            .groupBy("lang", "prefix", "next").agg(F.sum("n").alias("n")))


def bucket_filter(level: DataFrame, least: int):
    """Filter of the buckets with ``least`` phrases or more: no phrase that frequent fails, whatever shares its bucket.

    A range of buckets is summed in one array of fixed size, its rows one after the other.
    FILTER_WORDS words reach the driver at most.
    """
    floor = min(least, 65_535)

    def run(batches):
        last, total = None, None

        def bits():
            bucket = np.uint64(last << RANGE_BITS) + np.flatnonzero(total >= floor).astype(np.uint64)
            word, bit = bucket & np.uint64(FILTER_WORDS - 1), np.uint64(1) << (bucket >> np.uint64(FILTER_WORDS.bit_length() - 1) & np.uint64(63))
            return pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bit.view(np.int64))], names=["word", "bits"])

        for batch in batches:
            for r, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if r != last:
                    if last is not None:
                        yield bits()
                    last, total = r, np.zeros(1 << RANGE_BITS, np.int64)
                total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint16)
        if last is not None:
            yield bits()

    rows = level.where("range is not null").select("range", "places", "counts").repartition("range").sortWithinPartitions("range")
    rows = rows.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    keep = np.zeros(FILTER_WORDS, np.uint64)
    keep[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return keep


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words by their lowest cut score.

    Level k counts phrases of k words as stripes: prefix -> next word. While it
    reads the texts it also counts phrases of one word more in hash buckets; a
    bucket below ``least`` holds no candidate, so the next level leaves its
    phrases out and counts the others exactly. From the stripes come the
    extensions (elements of ``least`` or more), the totals of all parts of a
    cut, and per phrase the largest count among its extensions to either side: a
    phrase inside a longer candidate as frequent as itself is inside one that is
    one word longer, so these maxima decide subsumption.

    Null language: ``und``. Null or empty text, and pieces without a word: none.
    Long texts are read whole. Repeated rows count as often as they stand there.
    Score ties go to the larger count, then the smaller phrase. Empty table:
    empty result. Products are decimals of 38 digits. Other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    texts = texts.where("text <> ''")
    level = stored(read_level(texts, 1, None, longest > 1), "phrase_level")
    words = stored(merged(level), "phrase_words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    found = [words.where(F.col("n") >= least).select("lang", "prefix", "next", F.col("next").alias("phrase"), F.lit(1).alias("len"), "n")]
    while len(found) < longest:
        keep = bucket_filter(level, least)
        if not keep.any():
            break
        k = len(found) + 1
        level = stored(read_level(texts, k, keep, k < longest), "phrase_level")
        found.append(stored(merged(level).where(F.col("n") >= least).select(
            "lang", "prefix", "next", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.lit(k).alias("len"), "n"), "phrase_stripes"))
    every = reduce(DataFrame.unionByName, found)
    counts = every.select("lang", "phrase", "n")

    candidates = every.where("len > 1")
    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    inside = (candidates.where("len > 2").select("lang", "n", F.explode(F.array("prefix", tail)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("n").alias("widest")))
    left = candidates.join(inside, ["lang", "phrase"], "left").where("widest is null or widest < n").select("lang", "phrase", "len", F.col("n").alias("a"))
    w = F.split("phrase", " ")
    cuts = left.select("lang", "phrase", "a", "len", F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice(w, F.col("k") + 1, F.col("len") - F.col("k")), " ").alias("rest"))
    scored = (cuts.join(counts.toDF("lang", "first", "l"), ["lang", "first"]).join(counts.toDF("lang", "rest", "r"), ["lang", "rest"])
              .join(totals, "lang")
              .withColumn("score", F.expr("(1000 * cast(a as decimal(19, 0)) * cast(total as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")))
    best = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.select("lang", "phrase", "a", "c.l", "c.r", F.col("total").alias("n"), F.col("c.score").alias("score"))
            .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


#: The same by all word windows.
ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
q AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
w AS (SELECT lang, id, unnest(w) AS w1, unnest(range(len(w))) AS i FROM q),
n AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5 FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
g AS (SELECT lang, 1 AS k, w1 AS phrase FROM n
      UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM n WHERE w2 IS NOT NULL
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM n WHERE w3 IS NOT NULL
      UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM n WHERE w4 IS NOT NULL
      UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM n WHERE w5 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
total AS (SELECT lang, sum(n)::hugeint AS n FROM f WHERE k = 1 GROUP BY lang),
h AS MATERIALIZED (SELECT * FROM f WHERE n >= 100),   -- all parts of a candidate are among them
c AS (SELECT *, string_split(phrase, ' ') AS w FROM h WHERE k > 1),
inside AS (
  SELECT lang, phrase, max(n) AS widest
  FROM (SELECT lang, n, array_to_string(w[b:e], ' ') AS phrase
        FROM c, range(1, 6) AS t(b), range(1, 6) AS u(e) WHERE e <= k AND e > b AND e - b + 1 < k)
  GROUP BY ALL),
cut AS (SELECT c.lang, c.phrase, c.n AS a, i, array_to_string(w[1:i], ' ') AS first, array_to_string(w[i + 1:], ' ') AS rest
        FROM c LEFT JOIN inside s ON s.lang = c.lang AND s.phrase = c.phrase, range(1, 5) AS t(i)
        WHERE i < k AND NOT coalesce(100 * s.widest >= 100 * c.n, false)),
scored AS (SELECT cut.lang, cut.phrase, a, i, l.n AS l, r.n AS r, total.n AS n, (1000::hugeint * a * total.n) // (l.n::hugeint * r.n) AS score
           FROM cut JOIN h l ON l.lang = cut.lang AND l.phrase = first JOIN h r ON r.lang = cut.lang AND r.phrase = rest JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n::bigint AS n, score::bigint AS score
FROM best
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY rank <= 2000
"""
