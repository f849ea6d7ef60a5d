"""Byte-level BPE encoding and decoding in padded numpy matrices."""

from __future__ import annotations

import gc
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.llm.common import pieces, table

#: Widest matrix row in bytes; longer pieces (hardly any) go one by one.
WIDE = 128
#: Matrix cells merged at a time, pieces remembered per worker, longest piece remembered.
CELLS, REMEMBER, SHORT = 1 << 20, 600_000, 64


class PairTable:
    """Open-addressing hash table in numpy: (left id, right id) -> merged id, which is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        self.none = np.int32(2**31 - 1)
        pairs = {}
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        size = 1 << max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - size.bit_length() + 1), size - 1
        self.keys = np.full(size, -1, np.int64)
        self.ids = np.full(size, self.none, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64).reshape(-1)
        vals = np.array(list(pairs.values()), np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):   # all still homeless keys try their slot; one per slot wins, the rest move on
            free = self.keys[slot[left]] == -1
            self.keys[slot[left[free]]] = keys[left[free]]
            won = self.keys[slot[left]] == keys[left]
            self.ids[slot[left[won]]] = vals[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask
        self.probes = 1
        probe, lost = self._slot(keys), np.ones(len(keys), bool)
        while lost.any():
            lost &= self.keys[probe] != keys
            probe = (probe + 1) & self.mask
            self.probes += bool(lost.any())

    def _slot(self, keys):
        import numpy as np

        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left, right):
        """Rank of each adjacent pair; ``none`` where it is no token. Negative ids are padding."""
        import numpy as np

        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(keys.shape, self.none, np.int32)
        slot = self._slot(keys)
        found = self.keys[slot]
        hit = found == keys
        out[hit] = self.ids[slot[hit]]
        todo = np.flatnonzero(~hit.ravel() & (found.ravel() != -1) & (right.ravel() >= 0) & (left.ravel() >= 0))
        keys, slot, flat = keys.ravel(), slot.ravel(), out.ravel()
        for _ in range(self.probes):
            if not len(todo):
                break
            at = slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[at]
            hit = found == keys[todo]
            flat[todo[hit]] = self.ids[at[hit]]
            todo = todo[~hit & (found != -1)]
        return flat.reshape(left.shape)


class Bpe:
    """Encoder and decoder for one rank table (token bytes -> rank) and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import numpy as np
        import regex

        self.split = regex.compile(pattern)
        self.words = {rank: word for word, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.words}
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(ranks)
        self.single = {rank: np.int32(rank).tobytes() for rank in self.words}
        self.known: dict[str, bytes] = {}

    def _matrix(self, rows: list[bytes]) -> list[bytes]:
        """Every row merges its leftmost minimum-rank pair each round; rows that are done leave."""
        import numpy as np

        lens = np.array([len(r) for r in rows])
        width = int(lens.max())
        ids = np.full((len(rows), width), -1, np.int32)
        flat = self.byte[np.frombuffer(b"".join(rows), np.uint8)]
        ids[np.arange(width) < lens[:, None]] = flat
        ranks = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        out: list = [None] * len(rows)
        live = np.arange(len(rows))
        none = self.pairs.none
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            best = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), none)
            done = best == none
            flat, step = ids[done].tobytes(), 4 * ids.shape[1]
            for k, (i, n) in enumerate(zip(live[done].tolist(), (4 * lens[done]).tolist())):
                out[i] = flat[k * step:k * step + n]
            if done.all():
                return out
            if done.any():
                keep = ~done
                live, ids, ranks, lens, at, best = live[keep], ids[keep], ranks[keep], lens[keep], at[keep], best[keep]
            # compaction: drop the right half of the merged pair, shift the rest to the left
            n, width = ids.shape
            row = np.arange(n)
            ids[row, at] = best
            keep = np.ones((n, width), bool)
            keep[row, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[row, at] = False
            ranks = ranks[keep].reshape(n, width - 2)
            lens = lens - 1
            # only the pairs beside the merged one have a new rank
            if ranks.shape[1]:
                has = at > 0
                ranks[row[has], at[has] - 1] = self.pairs.rank(ids[row[has], at[has] - 1], best[has])
                has = at < width - 2
                ranks[row[has], at[has]] = self.pairs.rank(best[has], ids[row[has], at[has] + 1])
                widest = int(lens.max())
                ids, ranks = ids[:, :widest], ranks[:, :max(0, widest - 1)]

    def _long(self, word: bytes) -> bytes:
        """One long row: all places of the minimum-rank pair at once, where that equals one after the other."""
        import numpy as np

        none = self.pairs.none
        ids = self.byte[np.frombuffer(word, np.uint8)]
        ranks = self.pairs.rank(ids[:-1], ids[1:])
        while len(ranks):
            least = ranks.min()
            if least == none:
                break
            at = np.flatnonzero(ranks == least)
            if len(at) > 1:   # of overlapping places take every other one, from the left
                run = np.flatnonzero(np.r_[True, np.diff(at) > 1])
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            # a merge that opens a pair of lower rank must be followed up first: then only the leftmost place
            inner = at[at > 0]
            prev = ids[inner - 1].copy()
            prev[np.isin(inner - 2, at)] = least
            after = at[at + 2 < len(ids)]
            opened = [self.pairs.rank(prev, np.full(len(inner), least, np.int32)), self.pairs.rank(np.full(len(after), least, np.int32), ids[after + 2])]
            if any((o < least).any() for o in opened):
                at = at[:1]
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            now = at - np.arange(len(at))
            keep = np.ones(len(ranks), bool)
            keep[at] = False
            ranks = ranks[keep]
            near = np.unique(np.r_[now - 1, now])
            near = near[(near >= 0) & (near < len(ranks))]
            ranks[near] = self.pairs.rank(ids[near], ids[near + 1])
        return ids.astype(np.int32).tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each piece (as int32 bytes): whole tokens at once, the rest in matrices by length (powers of two)."""
        import numpy as np

        raws = [w.encode() for w in words]
        out = [None if r is None else self.single[r] for r in map(self.ranks.get, raws)]
        todo = np.array([i for i, ids in enumerate(out) if ids is None], np.int64)
        lens = np.array([len(raws[i]) for i in todo])
        wide = np.ceil(np.log2(np.maximum(lens, 1))).astype(int)
        for bits in np.unique(wide).tolist():
            rows = todo[wide == bits].tolist()
            if 1 << bits > WIDE:
                for i in rows:
                    out[i] = self._long(raws[i])
                continue
            step = max(1, CELLS >> bits)
            for start in range(0, len(rows), step):
                part = rows[start:start + step]
                for i, ids in zip(part, self._matrix([raws[i] for i in part])):
                    out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text; each piece of the batch that isn't known yet is encoded once."""
        import numpy as np

        split = list(map(self.split.findall, texts))
        seen = set().union(*split)
        if len(self.known) + len(seen) > REMEMBER:
            self.known = {}
        known = self.known
        fresh = list(seen.difference(known))
        known.update(zip(fresh, self.encode_words(fresh)))
        out = [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32).tolist() for words in split]
        for w in fresh:
            if len(w) > SHORT:   # hardly seen again, and large
                del known[w]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def read_ranks(path: str) -> bytes:
    """The rank file's bytes (a vocabulary: bounded, under 1 MB), read where the job is built."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    import base64

    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, data.splitlines()))}


_BPE: dict = {}


def worker_bpe(data: bytes, pattern: str) -> Bpe:
    """One encoder per Python worker and vocabulary."""
    key = hashlib.sha256(data).digest(), pattern
    if key not in _BPE:
        _BPE.clear()
        _BPE[key] = Bpe(parse_ranks(data), pattern)
    return _BPE[key]


def bpe(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``keep_ids`` the ids (array of int).

    Each match of ``pattern`` is encoded separately by the ranks in ``path``, no
    special tokens; the ids are decoded again. One map over the documents, no
    shuffle. Null text is encoded as empty (no tokens). A piece longer than 128
    bytes is merged on its own, not in a matrix. Repeated rows give equal results;
    other columns are not read.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches):
        import pyarrow as pa

        coder = worker_bpe(ranks.value, pattern)
        gc.disable()   # there are no cycles here, but millions of tuples to walk
        name = coder.names.__getitem__
        for batch in pieces(batches, 512, 1, 1 << 20):
            ids = coder.encode(["" if t is None else t for t in batch.column(1).to_pylist()])
            cols = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join(map(name, x)).encode()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids], pa.string())]
            if keep_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(table(spark, sf_dir, "documents"), *vocabulary())


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token ids per document."""
    return bpe(docs, *vocabulary(), keep_ids=True)
