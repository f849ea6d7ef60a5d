"""Line labelling with a linear-chain conditional random field; content share decides retention."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.llm.common import hash_sample, pieces, table

#: Bounds of the training sample: labelled documents, and lines of each.
SAMPLE_DOCS, SAMPLE_LINES = 1000, 32
#: Least share of a document's characters that lie in content lines.
CONTENT_SHARE = 0.5

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
N_FEATURES = 13
#: Place of a line's own words among its features; those of the line before come last.
_WORDS = 7


def share_without(line: bytes, drop: bytes) -> int:
    return len(line) - len(line.translate(None, drop))


def line_features(line: bytes, words: list[bytes], repeated: bool, neighbour: int) -> list[float]:
    """Features of a line, each about 0 to 1. ``neighbour``: words in the line before."""
    n, k = len(line), len(words)
    chars = n - k + 1
    mean = chars / k
    return [
        1.0,
        min(1.0, 4 * share_without(line, SYMBOLS) / n),
        min(1.0, 4 * line.count(b"!") / n),
        min(1.0, 2 * share_without(line, _UPPER) / n),
        min(1.0, 4 * share_without(line, _DIGIT) / n),
        1 - len(set(words)) / k,
        float(repeated),
        min(k, 64) / 64,
        float(k < 4),
        min(1.0, mean / 20),
        float(mean < 2.5),
        sum(map(bytes.__eq__, words, words[1:])) / k,
        min(neighbour, 64) / 64,
    ]


def line_table(raw: bytes) -> tuple[list[list[float]], list[int], int]:
    """(features, bytes) of the lines that have a word, and how many of them equal an earlier line."""
    feats, sizes, seen, repeats, before = [], [], set(), 0, 0
    for line in raw.split(b"\n"):
        words = line.split()
        if words:
            again = line in seen
            repeats += again
            seen.add(line)
            feats.append(line_features(line, words, again, before))
            sizes.append(len(line))
            before = len(words)
    return feats, sizes, repeats


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    grams = list(zip(*(words[i:] for i in range(width))))
    if len(set(grams)) == len(grams):
        return 0
    count = Counter(grams)
    marked, end = 0, 0
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            marked += i + width - max(i, end)
            end = i + width
    return marked


def viterbi(feats, weights) -> list[int]:
    """Best label sequence (1: content) for line features; weights: (emission [F], transition [2][2], start [2])."""
    import numpy as np

    emit, move, start = weights
    score = (np.asarray(feats) @ emit).tolist()   # of content against boilerplate
    (m00, m01), (m10, m11) = move
    a, b = start[0], start[1] + score[0]
    back = []
    for s in score[1:]:
        from0, from1 = a + m00 >= b + m10, a + m01 >= b + m11
        a, b = (a + m00 if from0 else b + m10), (a + m01 if from1 else b + m11) + s
        back.append((0 if from0 else 1, 0 if from1 else 1))
    out = [int(b > a)]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


def line_labels(sequences: list[tuple[list[list[float]], int]], rounds: int = 3, lean: float = 1.0) -> list:
    """Labels of every line (1: content) from labels of whole documents.

    A logistic model of single lines learns from the documents' labels; a line
    then keeps its document's label unless the model is surer of the other by
    more than ``lean``, and the model learns anew from the lines' labels. So a
    menu in a good document and a paragraph in a bad one get labels of their own.
    """
    import numpy as np

    x = np.concatenate([np.asarray(f) for f, _ in sequences])
    own = np.repeat([y for _, y in sequences], [len(f) for f, _ in sequences])
    weight = np.repeat([1 / len(f) for f, _ in sequences], [len(f) for f, _ in sequences])
    y = own
    for _ in range(rounds):
        if len(set(y.tolist())) < 2:
            break
        w = weight * np.where(y == 1, 0.5 / weight[y == 1].sum(), 0.5 / weight[y == 0].sum())
        theta, curve = np.zeros(N_FEATURES), np.eye(N_FEATURES) * 1e-4
        for _ in range(30):     # Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + curve, x.T @ (w * (y - p)) - 1e-4 * theta)
            theta = theta + np.clip(step, -2, 2)
        y = (x @ theta + np.where(own == 1, lean, -lean) > 0).astype(int)
    return np.split(y, np.cumsum([len(f) for f, _ in sequences])[:-1])


def spliced(sequences: list, labels: list, seed: int = 5) -> list:
    """(features, labels) of the documents as they are, and of each once more with a run of lines of the other
    label put in: what a page with a menu, or a menu with a paragraph, looks like."""
    import numpy as np

    rng = np.random.default_rng(seed)
    pool = {y: [f for (feats, _), ys in zip(sequences, labels) for f, v in zip(feats, ys) if v == y] for y in (0, 1)}
    out = []
    for (feats, _), ys in zip(sequences, labels):
        out.append((feats, ys))
        for _ in range(int(rng.integers(1, 3))):
            other = 1 - int(ys.mean() >= 0.5)
            if not pool[other]:
                continue
            at, n = int(rng.choice([0, len(feats), rng.integers(0, len(feats) + 1)])), int(rng.integers(1, 4))
            run = [pool[other][int(k)] for k in rng.integers(0, len(pool[other]), n)]
            feats, ys = [*feats[:at], *run, *feats[at:]], np.r_[ys[:at], np.full(n, other), ys[at:]]
        # the words of the line before, as the lines now stand
        out.append(([[*f[:-1], feats[i - 1][_WORDS] if i else 0.0] for i, f in enumerate(feats)], ys))
    return out


def fit(sequences: list[tuple[list[list[float]], int]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3):
    """Weights of the field from (line features, label) of documents, by full-batch gradient steps.

    Lines get labels of their own first, and documents are mixed with lines of
    the other label; sequences are padded to a matrix and the forward-backward
    sums run over all of them at a time. Without documents of both labels:
    every line is content.
    """
    import numpy as np

    if len({y for _, y in sequences}) < 2:
        return np.r_[1.0, np.zeros(N_FEATURES - 1)], [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0]
    labelled = spliced(sequences, line_labels(sequences))
    n, t = len(labelled), max(len(x) for x, _ in labelled)
    x, y, mask = np.zeros((n, t, N_FEATURES)), np.zeros((n, t), int), np.zeros((n, t), bool)
    for i, (feats, ys) in enumerate(labelled):
        x[i, :len(feats)], y[i, :len(feats)], mask[i, :len(feats)] = feats, ys, True
    weight = np.full(n, 1 / n)
    theta = np.zeros(N_FEATURES + 6)
    m = v = np.zeros_like(theta)
    at = np.arange(n)
    for k in range(1, rounds + 1):
        emit, move, start = theta[:N_FEATURES], theta[N_FEATURES:-2].reshape(2, 2), theta[-2:]
        score = np.stack([np.zeros((n, t)), x @ emit], axis=2)
        fwd = np.empty((n, t, 2))
        fwd[:, 0] = start + score[:, 0]
        for i in range(1, t):
            step = np.logaddexp(fwd[:, i - 1, :1] + move[0], fwd[:, i - 1, 1:] + move[1]) + score[:, i]
            fwd[:, i] = np.where(mask[:, i, None], step, fwd[:, i - 1])
        norm = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        bwd = np.zeros((n, t, 2))
        pair = np.zeros((2, 2))
        for i in range(t - 1, 0, -1):
            ahead = score[:, i] + bwd[:, i]
            both = fwd[:, i - 1, :, None] + move + ahead[:, None, :] - norm[:, None, None]
            live = mask[:, i] * weight
            pair += (np.exp(np.minimum(both, 0)) * live[:, None, None]).sum(0)
            step = np.logaddexp(move[:, 0] + ahead[:, :1], move[:, 1] + ahead[:, 1:])
            bwd[:, i - 1] = np.where(mask[:, i, None], step, bwd[:, i])
        prob = np.exp(np.minimum(fwd + bwd - norm[:, None, None], 0)) * (mask * weight[:, None])[:, :, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1], y[:, 1:]), mask[:, 1:] * weight[:, None])
        first = np.zeros(2)
        np.add.at(first, y[:, 0], weight)
        grad = np.concatenate([
            ((y * mask * weight[:, None])[:, :, None] * x).sum((0, 1)) - (prob[:, :, 1:] * x).sum((0, 1)),
            (seen - pair).ravel(), first - prob[at, 0].sum(0)]) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return theta[:N_FEATURES], theta[N_FEATURES:-2].reshape(2, 2).tolist(), theta[-2:].tolist()


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS):
    """Field fitted on a bounded sample: ``sample_docs`` labelled documents chosen by hash, the first lines of each."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = hash_sample(known, sample_docs, "doc_id")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                           T.StructField("feats", T.ArrayType(T.ArrayType(T.DoubleType())))])

    def run(batches):
        import pyarrow as pa

        for batch in pieces(batches, 256, 2):
            feats = [line_table((t or "").encode())[0][:SAMPLE_LINES] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(feats, pa.list_(pa.list_(pa.float64())))], names=schema.names)

    # one row per doc_id, however often it stands there; its text of least hash
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(picked, "doc_id")
            .groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
            .select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text").mapInArrow(run, schema).collect())
    rows.sort(key=lambda r: (r.doc_id, repr(r.feats)))
    return fit([(r.feats, r.quality) for r in rows if r.feats])


def judge_text(text: str | None, weights, content_share: float) -> tuple:
    """Counts, content share, base verdict and verdict of one text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    repeats = repeat_words(words)
    feats, sizes, dups = line_table(raw)
    labels = viterbi(feats, weights) if feats else []
    share = sum(s for s, y in zip(sizes, labels) if y) / max(1, sum(sizes))
    failed = n < 10 or 100 * repeats > 20 * n
    return (n, len(text or "") - share_without(raw, SPACE), share_without(raw, SYMBOLS), dups, repeats, len(feats), sum(labels),
            share, failed, not failed and share >= content_share)


def judge(docs: DataFrame, weights, content_share: float = CONTENT_SHARE) -> DataFrame:
    """Every document's counts, base verdict, content share and final verdict.

    One map over the documents, no shuffle; each text is held alone and whole.
    Null or empty text: no words, fails the base rules, content_share 0. Empty
    table: empty result. A line without a word is not labelled. Repeated rows are judged alike; other columns
    are not read.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_lines"]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in counts],
                           T.StructField("content_share", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        import pyarrow as pa

        for batch in pieces(batches, 256, 1):
            rows = [judge_text(t, weights, content_share) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*rows))], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. The verdict is made in the row: no join back by doc_id."""
    weights = train(docs, table(spark, sf_dir, "labels"))
    schema = T.StructType(list(docs.schema))
    text = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in pieces(batches, 256, text):
            yield batch.filter(pa.array([judge_text(t, weights, CONTENT_SHARE)[-1] for t in batch.column(text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)
