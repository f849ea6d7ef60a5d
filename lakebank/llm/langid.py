"""Language identification by prediction by partial matching: the shortest code length wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakebank.llm.common import pieces, stored, table

#: Bytes of the longest context.
ORDER = 4
#: Bounds of the training sample: characters of a chunk, chunks of a language, and table cells of all languages together.
CHUNK, CHUNKS, CELLS = 1024, 256, 1 << 26
#: Code lengths are whole multiples of this share of a bit, so that sums are exact in any order.
UNIT = 1 << 16
#: Positions scored at a time (less with many languages).
STEP = 1 << 18

UNKNOWN = "und"
_EMPTY = (1 << 64) - 1


class Keys:
    """Row numbers of distinct 64-bit keys: an open-addressing table filled and searched by whole arrays."""

    def __init__(self, keys):
        import numpy as np

        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.key = np.full(1 << bits, _EMPTY, np.uint64)
        self.row = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self.first(keys)
        while len(left):
            free = self.key[at] == _EMPTY
            self.key[at[free]] = keys[left[free]]
            done = self.key[at] == keys[left]
            self.row[at[done]] = left[done]
            left, at = left[~done], at[~done] + np.uint64(1) & self.mask

    def first(self, keys):
        import numpy as np

        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys):
        """Row of every key, -1 where it is unknown."""
        import numpy as np

        at = self.first(keys)
        held = self.key[at]
        out = np.where(held == keys, self.row[at], -1)
        open_ = np.flatnonzero((held != keys) & (held != _EMPTY))
        at = at[open_]
        while len(open_):
            at = at + np.uint64(1) & self.mask
            held, want = self.key[at], keys[open_]
            hit = held == want
            out[open_[hit]] = self.row[at[hit]]
            more = ~hit & (held != _EMPTY)
            open_, at = open_[more], at[more]
        return out


def normalised(text: str) -> bytes:
    """Lower-cased UTF-8 bytes behind a context of line ends."""
    return b"\n" * ORDER + text.lower().encode()


def windows(data, order: int = ORDER):
    """Every byte with the ``order`` bytes before it, packed into one number (the byte itself lowest)."""
    import numpy as np

    out = np.zeros(len(data) - order, np.uint64)
    for j in range(order + 1):
        out = out << np.uint64(8) | data[j:len(data) - order + j]
    return out


class Model:
    """Frozen context trees of all languages as one pair of tables per order.

    A context of k bytes that a language has seen T times, before D distinct
    bytes, gives byte s with count c the probability c / (T + D); the escape
    D / (T + D) goes to the next shorter context, without the bytes that the
    longer one has given already. Contexts that a language has not seen cost
    nothing; below order 0 all bytes are alike. The probabilities of all bytes
    sum to one in every context, so the code lengths are exact.
    """

    def __init__(self, chunks: dict[str, list[bytes]]):
        import numpy as np

        self.langs = sorted(chunks, key=str.encode)
        n = len(self.langs)
        seen = [np.concatenate([windows(np.frombuffer(c, np.uint8)) for c in chunks[lang] if len(c) > ORDER] or [np.zeros(0, np.uint64)]) for lang in self.langs]
        self.grams, self.lengths, self.contexts, self.escapes = [], [], [], []
        lower = None
        for k in range(ORDER + 1):
            mask = np.uint64((1 << 8 * (k + 1)) - 1)
            counted = [np.unique(s & mask, return_counts=True) for s in seen]
            grams = np.unique(np.concatenate([g for g, _ in counted])) if n else np.zeros(0, np.uint64)
            count = np.zeros((len(grams), n))
            for j, (g, c) in enumerate(counted):
                count[np.searchsorted(grams, g), j] = c
            contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
            total, distinct, given = (np.zeros((len(contexts), n)) for _ in range(3))
            np.add.at(total, of, count)
            np.add.at(distinct, of, count > 0)
            below = np.full((len(grams), n), 1 / 256) if lower is None else lower[1][np.searchsorted(lower[0], grams & (mask >> np.uint64(8)))]
            np.add.at(given, of, np.where(count > 0, below, 0))
            escape = np.where(total > 0, distinct / np.maximum(total + distinct, 1) / np.maximum(1 - given, 1e-12), 1.0)
            prob = np.where(count > 0, count / np.maximum(total + distinct, 1)[of], escape[of] * below)
            self.grams.append(Keys(grams))
            self.contexts.append(Keys(contexts))
            self.lengths.append(np.rint(-np.log2(prob) * UNIT).astype(np.int32))
            self.escapes.append(np.rint(-np.log2(escape) * UNIT).astype(np.int32))
            lower = grams, prob

    def cost(self, keys, k: int = ORDER):
        """Code length of every window (context and byte) in every language, in units."""
        import numpy as np

        if k < 0:
            return np.full((len(keys), len(self.langs)), 8 * UNIT, np.int32)
        row = self.grams[k].find(keys)
        out = self.lengths[k].take(row, axis=0, mode="clip") if len(self.lengths[k]) else np.zeros((len(keys), len(self.langs)), np.int32)
        new = np.flatnonzero(row < 0)
        if len(new):
            context = self.contexts[k].find(keys[new] >> np.uint64(8))
            shorter = self.cost(keys[new] & np.uint64((1 << 8 * k) - 1), k - 1)
            known = np.flatnonzero(context >= 0)
            shorter[known] += self.escapes[k][context[known]]
            out[new] = shorter
        return out

    def code_lengths(self, texts: list[bytes]):
        """Code length of every text in every language, in units."""
        import numpy as np

        out = np.zeros((len(texts), len(self.langs)), np.int64)
        ends = np.cumsum([len(t) - ORDER for t in texts])
        data = b"".join(texts)
        starts = np.r_[0, np.cumsum([len(t) for t in texts])]
        raw = np.frombuffer(data, np.uint8)
        keys = np.concatenate([windows(raw[a:b]) for a, b in zip(starts, starts[1:])])
        step = max(4096, STEP * 4 // max(4, len(self.langs)))
        for a in range(0, len(keys), step):
            part = self.cost(keys[a:a + step])
            first = np.searchsorted(ends, a, side="right")
            last = np.searchsorted(ends, a + len(part) - 1, side="right")
            own = np.arange(first, last + 1)
            own = own[np.diff(np.r_[0, ends])[own] > 0]   # empty texts have no position
            begin = np.maximum(np.r_[0, ends][own] - a, 0)
            out[own] += np.add.reduceat(part, begin, axis=0, dtype=np.int64)
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of every text. Score: the share of the best language in the mean probabilities of a byte."""
        import numpy as np

        told = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.langs else []
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if told:
            raw = [normalised(texts[i]) for i in told]
            cost = self.code_lengths(raw)
            best = cost.argmin(1)   # ties: the first language
            mean = 2.0 ** ((cost.min(1)[:, None] - cost) / (UNIT * np.array([[len(r) - ORDER] for r in raw])))
            for i, b, s in zip(told, best.tolist(), (1 / mean.sum(1)).tolist()):
                langs[i], scores[i] = self.langs[b], s
        return langs, scores


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5


def training_chunks(docs: DataFrame, chunk: int = CHUNK, chunks: int = CHUNKS) -> dict[str, list[bytes]]:
    """Per language the texts' chunks of least hash, ``chunks`` at most (fewer with so many languages that
    the tables would pass CELLS): a bounded sample of all labelled texts that are not held out."""
    known = docs.where(remainder() != 0).where("lang is not null and text <> ''").select(F.col("lang").cast("string").alias("lang"), "doc_id", F.col("text").cast("string").alias("text"))
    last = F.floor((F.length("text") - 1) / F.lit(chunk)).cast("int")
    # written first, so the planner knows that it is small and the texts stay where they are
    sizes = stored(known.groupBy("lang").agg(F.sum(last + 1).alias("held")), "lang_chunks")
    n = sizes.count()
    each = max(1, min(chunks, CELLS // max(1, (ORDER + 1) * chunk * n * n)))
    h = F.pmod(F.xxhash64("doc_id", "at"), F.lit(1 << 30))
    # the threshold lets about twice as many through as are taken
    rows = (known.join(sizes, "lang").select("lang", "doc_id", "text", "held", F.explode(F.sequence(F.lit(0), last)).alias("at"))
            .withColumn("h", h).where(F.col("h") < F.lit(2 * each << 30) / F.col("held"))
            .select("lang", "h", F.substring("text", F.col("at") * chunk + 1, F.lit(chunk)).alias("part")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "part"))
    out: dict[str, list[bytes]] = {}
    for r in rows.withColumn("rank", rank).where(F.col("rank") <= each).orderBy("lang", "rank").collect():
        out.setdefault(r.lang, []).append(r.part.lower().encode())
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Every document's doc_id, held_out, lang_pred and score.

    One map over the whole texts, no shuffle; a text is coded as it stands, lower-cased.
    Null text or text without a letter: ``und``, score 0; so is every text if no
    language could be learnt. Null doc_id: not held out, nor learnt from. Repeated
    rows are judged alike; ties go to the first language in byte order. Very long
    texts are scored some positions at a time. Empty table: empty result. Other
    columns are not read.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        for batch in pieces(batches, 1024, 2, 1 << 20):
            langs, scores = model.judge(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op11_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return predict(docs, Model(training_chunks(docs)))
