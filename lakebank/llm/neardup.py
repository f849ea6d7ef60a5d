"""Near duplicates: SuperMinHash signatures, banding, exact verification and union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakebank.llm.common import components, pieces, stored, table

@dataclass(frozen=True)
class Rule:
    """What counts as near: words of a shingle, least similarity in percent, bands and rows of the signature, and the
    estimated similarity from which a pair is verified.

    Two sets of similarity s share no band with probability (1 - s^rows)^bands:
    4e-7 at 0.85 with 25 bands of 5, 5e-5 at 0.8, 3e-6 at 0.84. The least estimate
    lies over four standard errors of the estimate (0.032 at 0.85 and 125
    positions, less with correlated ranks) below the least similarity.
    """

    width: int = 3
    percent: int = 85
    bands: int = 25
    rows: int = 5
    least_estimate: float = 0.70


#: The query's rule by its contract, and the pipeline's: five words and 0.8.
QUERY_RULE, STAGE_RULE = Rule(), Rule(5, 80, 25, 5, 0.65)
#: Members of a bucket that all others are compared with first. Members and shingles of a
#: bucket block (two blocks are compared at a time), and shingles hashed at a time.
PIVOTS, BLOCK, BLOCK_SHINGLES, CHUNK = 8, 2048, 1 << 21, 1 << 18

_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(x):
    """Splitmix64 finaliser on uint64 arrays."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[str | None], hashes: WordHashes, width: int = QUERY_RULE.width) -> list:
    """Per text the sorted distinct 64-bit hashes of its shingles (uint64).

    Words are runs of anything but ASCII white space, A-Z lower-cased; fewer
    words than a shingle make one shingle; no words, the empty set.
    """
    import numpy as np

    out = []
    for text in texts:
        words = (text or "").encode().lower().split()   # bytes: ASCII letters and white space only
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        if len(h) > width:
            parts = [h[i:len(h) - width + 1 + i] for i in range(width)]
        else:
            parts = [h[i:i + 1] for i in range(len(h))]
        acc = np.zeros(len(parts[0]) if parts else 0, np.uint64)
        for part in parts:
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + part)
        out.append(np.unique(acc + np.uint64(min(len(h), width))) if len(h) else acc)
    return out


def superminhash(sets: list, size: int):
    """SuperMinHash signatures (float64, one row per set; sets must not be empty).

    Every element draws a random permutation of the positions and one value per
    rank j, in [j, j + 1); a position keeps its least value. Ranks are taken
    level by level over all elements at once: once every position of a set is
    filled, no later rank can be smaller, and the set stops early. Fisher-Yates
    swaps are kept only for elements of sets that go on.
    """
    import numpy as np

    sig = np.full((len(sets), size), np.inf)
    flat = sig.ravel()
    elem = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    perm = None
    for j in range(size):
        rnd = mix(elem + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        k = j + ((rnd >> np.uint64(40)) * np.uint64(size - j) >> np.uint64(24)).astype(np.int64)
        value = j + (mix(rnd) >> np.uint64(12)).astype(np.float64) * 2.0**-52
        if perm is None:
            pos, first = k, k
        else:
            at = np.arange(len(elem))
            pos = perm[at, k]
            perm[at, k] = perm[at, j]
        np.minimum.at(flat, owner * size + pos, value)
        open_ = np.isinf(sig).any(1)
        live = open_[owner]
        if not live.any():
            return sig
        elem, owner = elem[live], owner[live]
        if perm is None:
            perm = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.int32), (len(elem), 1))
            perm[np.arange(len(elem)), first[live]] = 0
        else:
            perm = perm[live]
    return sig


def fingerprints(texts: DataFrame, rule: Rule) -> DataFrame:
    """From (row, doc_id, text): row, doc_id, n, same (hash of the whole set), sig (four bits per position) and bands (hashes) of every document."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("same", T.BinaryType()),
                           T.StructField("sig", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    size = rule.bands * rule.rows

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in pieces(batches, 256, 2, 1 << 20):
            sets = shingle_sets(batch.column(2).to_pylist(), hashes, rule.width)
            full = [i for i, s in enumerate(sets) if len(s)]
            sigs: list = [None] * len(sets)
            bands: list = [None] * len(sets)
            start = total = 0
            for end, i in enumerate(full):
                total += len(sets[i])
                if total < CHUNK and end + 1 < len(full):
                    continue
                part = full[start:end + 1]
                sig = superminhash([sets[x] for x in part], size)
                bits = mix(sig.view(np.uint64))
                low = np.zeros((len(part), size + size % 2), np.uint8)
                low[:, :size] = bits & np.uint64(15)
                low = low[:, ::2] | low[:, 1::2] << 4
                keys = np.arange(1, rule.bands + 1, dtype=np.uint64) * np.uint64(_M2) + np.zeros((len(part), 1), np.uint64)
                for r in range(rule.rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, r::rule.rows])
                for x, s, b in zip(part, low, keys.view(np.int64).tolist()):
                    sigs[x], bands[x] = s.tobytes(), b
                start, total = end + 1, 0
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return texts.select("row", "doc_id", "text").mapInArrow(run, schema)


class Groups:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def contract(edges: DataFrame) -> DataFrame:
    """Union-find within each task's share of the edges (taken in bounded batches): a forest with the same components."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            u, v = (batch.column(i).to_numpy() for i in (0, 1))
            nodes, at = np.unique(np.r_[u, v], return_inverse=True)
            groups = Groups(len(nodes))
            for a, b in zip(at[:len(u)].tolist(), at[len(u):].tolist()):
                groups.join(a, b)
            root = np.array([groups.find(i) for i in range(len(nodes))], np.int64)
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[root[moved]]), pa.array(nodes[moved])], names=["u", "v"])

    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).mapInArrow(run, "u long, v long").distinct()


def by_bucket(batches: Iterator, key: int = 0) -> Iterator:
    """Consecutive runs of equal keys in a sorted stream of Arrow batches, each as one table. A run is a bounded bucket block."""
    import numpy as np
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.rec.fromarrays([batch.column(i).to_numpy() for i in range(key + 1)])
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        if held and tuple(c[held[-1].num_rows - 1].as_py() for c in held[-1].columns[:key + 1]) != tuple(c[0].as_py() for c in batch.columns[:key + 1]):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            if b < batch.num_rows:
                yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
                held = []
            else:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def whole_buckets(batches: Iterator, key: int) -> Iterator:
    """As ``by_bucket``, but all buckets that end in a batch as one table."""
    import numpy as np
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.rec.fromarrays([batch.column(i).to_numpy() for i in range(key + 1)])
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if len(cuts):
            yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
            held = [batch.slice(cuts[-1])]
        elif held and tuple(c[held[-1].num_rows - 1].as_py() for c in held[-1].columns[:key + 1]) != tuple(c[0].as_py() for c in batch.columns[:key + 1]):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def signatures(column):
    """A column of packed signatures as a matrix."""
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def agreeing(a, b, rule: Rule):
    """Equal positions of packed signatures. Different values of a position agree by chance in one of 16 cases, so the
    estimate may be high (and a pair verified for nothing), never low."""
    x, size = a ^ b, rule.bands * rule.rows
    return (x < 16).sum(-1) + (x & 15 == 0).sum(-1) - size % 2


def near(same, n, m, rule: Rule):
    """Whether equal positions and set sizes allow the similarity."""
    import numpy as np

    return (same >= rule.least_estimate * rule.bands * rule.rows) & (100 * np.minimum(n, m) >= rule.percent * np.maximum(n, m))


def compared(members: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """``members`` (key, id, n, blocks) with one and two: the likeliest of the bucket's pivots, if any is near.

    Pivots are the PIVOTS members of a bucket with the least hash. A bucket of more than one block is cut into
    slices and its pivots go to each as guests, so the work is linear in the members however many a bucket has.
    In other buckets the first rows are the pivots. Signatures (of ``reps``) move to their bucket once, and none
    is written.
    """
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("blocks", T.LongType()),
                           T.StructField("one", T.LongType()), T.StructField("two", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in whole_buckets(batches, 1):
            key, piece, own, ids, sizes = (part[c].to_numpy() for c in ("key", "slice", "own", "id", "n"))
            sig = signatures(part["sig"])
            fresh = np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])]
            starts, unit = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            guests = np.add.reduceat((~own).astype(np.int64), starts)       # they come first
            pivots = np.where(guests > 0, guests, np.minimum(np.diff(np.r_[starts, len(key)]), PIVOTS))
            score, other = np.full((len(key), max(PIVOTS, 2)), -1), np.zeros((len(key), max(PIVOTS, 2)), np.int64)
            for p in range(PIVOTS):
                at = np.flatnonzero(own & (p < pivots[unit]))
                pivot = starts[unit[at]] + p
                same = agreeing(sig[at], sig[pivot], rule)
                good = near(same, sizes[at], sizes[pivot], rule) & (ids[at] != ids[pivot])
                score[at[good], p], other[at[good], p] = same[good], ids[pivot[good]]
            order = np.lexsort((other, -score), axis=1)
            mine = pa.array(np.flatnonzero(own))
            best = []
            for place in (0, 1):
                pick = order[own, place][:, None]
                best.append(pa.array(np.take_along_axis(other[own], pick, 1)[:, 0], mask=np.take_along_axis(score[own], pick, 1)[:, 0] < 0))
            if len(mine):
                yield pa.RecordBatch.from_arrays([*(part[c].take(mine).combine_chunks() for c in ("key", "id", "n", "blocks")), *best], names=schema.names)

    sigs, hashed = reps.select("id", "sig"), F.xxhash64("id")
    order = Window.partitionBy("key").orderBy(hashed, "id")
    chosen = members.where("blocks > 1").withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
    cols = lambda piece, own: ["key", piece.alias("slice"), F.lit(own).alias("own"), hashed.alias("hash"), "id", "n", "blocks"]
    guests = chosen.select(*cols(F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)), False))
    units = members.select(*cols(F.pmod(hashed, F.col("blocks")), True)).unionByName(guests).join(sigs, "id")
    units = units.select("key", "slice", "own", "hash", "id", "n", "blocks", "sig")
    return units.repartition("key", "slice").sortWithinPartitions("key", "slice", "own", "hash", "id").mapInArrow(run, schema)


def open_members(marked: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """(key, one, two, id, comp) of the members that still have a likely partner in another component, untested in
    their bucket.

    Buckets of one component give none. In the others the members outside the
    largest component meet all members; both sides are cut into blocks, so a
    unit (key, one, two) is of bounded size, and a large group of copies is not
    compared with itself.
    """
    held = marked.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = held.groupBy("key").agg(F.sum("n").alias("held"), F.max(F.struct("n", "comp")).alias("m")).where("m.n < held").select(
        "key", F.col("m.comp").alias("main"), ((F.col("held") - F.col("m.n")) / F.col("held")).alias("share"))
    rows = marked.join(main, "key").join(reps.select("id", "sig"), "id").withColumn("others", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("blocks") * F.col("share")).cast("long")))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    tail = ["id", "n", "sig", "comp", F.col("one").alias("t1"), F.col("two").alias("t2")]
    own = rows.select("key", mine("blocks").alias("b1"), every("others").alias("b2"), F.lit(False).alias("rest"), *tail)
    rest = rows.where("comp <> main").select("key", every("blocks").alias("b1"), mine("others").alias("b2"), F.lit(True).alias("rest"), *tail)
    units = own.unionByName(rest).withColumnsRenamed({"b1": "one", "b2": "two"})

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in by_bucket(batches, 2):
            ids, sizes, comps = (part[c].to_numpy() for c in ("id", "n", "comp"))
            rest = part["rest"].to_numpy()
            t1, t2 = (part[c].fill_null(-1).to_numpy() for c in ("t1", "t2"))
            own = np.flatnonzero(~rest)
            if not len(own) or not rest.any():
                continue
            sigs = signatures(part["sig"])
            left = np.zeros(len(ids), bool)
            for i in np.flatnonzero(rest):
                open_ = (comps[own] != comps[i]) & near(agreeing(sigs[own], sigs[i], rule), sizes[own], sizes[i], rule)
                open_ &= (t1[own] != ids[i]) & (t2[own] != ids[i]) & (ids[own] != t1[i]) & (ids[own] != t2[i])
                left[own[open_]] = True
                left[i] |= open_.any()
            at = np.flatnonzero(left)
            at = at[np.unique(ids[at], return_index=True)[1]]
            if len(at):
                yield pa.RecordBatch.from_arrays([part[c].take(pa.array(at)).combine_chunks() for c in ("key", "one", "two", "id", "comp")],
                                                 names=["key", "one", "two", "id", "comp"])

    units = units.select("key", "one", "two", "id", "n", "sig", "comp", "rest", "t1", "t2")
    units = units.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "id")
    return units.mapInArrow(run, "key long, one long, two long, id long, comp long")


def linked(sets: list, comps, percent: int) -> list[tuple[int, int]]:
    """Links of ``percent`` similarity or more that join members of different components, decided on the full sets.

    Intersections of all members at once: a product of membership matrices over
    the shingles that two or more hold, some columns at a time.
    """
    import numpy as np

    sizes = np.array([len(s) for s in sets])
    shingle, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), sizes)
    shared = count[at] > 1
    column, member = (np.cumsum(count > 1) - 1)[at[shared]], member[shared]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    wide = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        a, b = np.searchsorted(column, [start, start + wide])
        held = np.zeros((len(sets), wide), np.float32)
        held[member[a:b], column[a:b] - start] = 1
        both += held @ held.T
    both = both.astype(np.int64)
    good = np.triu(100 * both >= percent * (sizes[:, None] + sizes - both), 1) & (comps[:, None] != comps)
    groups = Groups(len(sets))
    first: dict[int, int] = {}
    for i, c in enumerate(comps.tolist()):
        groups.join(first.setdefault(c, i), i)
    return [(i, j) for i, j in np.argwhere(good).tolist() if groups.join(i, j)]


def closing_links(open_: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Exact links between components among the open members of each bucket block. Linear in the members."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in by_bucket(batches, 2):
            ids = part["id"].to_numpy()
            pairs = linked([np.frombuffer(s, np.uint64) for s in part["shingles"].to_pylist()], part["comp"].to_numpy(), rule.percent)
            if pairs:
                i, j = np.array(pairs).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], names=["u", "v"])

    rows = open_.join(sets.select("id", "shingles"), "id").select("key", "one", "two", "id", "comp", "shingles")
    return rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "id").mapInArrow(run, "u long, v long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose full sets are similar enough, compared in batches."""
    a = sets.select(F.col("id").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("id").alias("v"), F.col("shingles").alias("sv"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in pieces(batches, 1024, 2):
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= rule.percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.join(a, "u").join(b, "v").select("u", "v", "su", "sv").mapInArrow(run, "u long, v long")


#: Words of 64 bits in the filter before a join: a bound of 2^18 rows whatever the input.
FILTER_WORDS = 1 << 18


def filtered(rows: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``likely``: whether ``by`` is in a bit filter of ``wanted``.

    Where it is false the value is not wanted; an exact join has to follow for the others. The filter has FILTER_WORDS
    rows at most, so it may be broadcast at any size; full, it lets all rows through to that join.
    """
    h = F.xxhash64(by)
    word, bit = h.bitwiseAND(F.lit(FILTER_WORDS - 1)).alias("word"), F.shiftrightunsigned(h, 18).bitwiseAND(F.lit(63)).cast("int")
    bits = wanted.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    return (rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(bits), "word", "left")
            .withColumn("likely", F.coalesce(F.getbit("bits", F.col("bit")) == 1, F.lit(False))).drop("word", "bit", "bits"))


def shingle_table(texts: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(id, shingles) of the wanted rows (row) of (row, doc_id, text), the full sets as bytes. A bit filter drops nearly
    all other texts before they move."""

    def run(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in pieces(batches, 256, 1, 1 << 20):
            sets = shingle_sets(batch.column(1).to_pylist(), hashes, rule.width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "shingles"])

    likely = filtered(texts.select("row", "text"), wanted, "row").where("likely")
    return likely.join(wanted, "row", "left_semi").select("row", "text").mapInArrow(run, "id long, shingles binary")


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc): every document with its row number, written once. A number taken anew in a later scan
    depends on how that scan is split, which changes with the executors at hand."""
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "dup_docs")


def groups(docs: DataFrame, rule: Rule = QUERY_RULE) -> DataFrame:
    """``row_groups`` of documents that have no row number yet."""
    return row_groups(numbered(docs.select("doc_id", "text")), rule)


def row_groups(rows: DataFrame, rule: Rule = QUERY_RULE) -> DataFrame:
    """From the stored (row, doc) of ``numbered``: row, doc_id, n_shingles, component_id, kept and group of every document.

    1. Every document's full shingle set gives a SuperMinHash signature and its
       bands. Equal sets form one class, however many copies it has; a class is
       known by one of its rows, never by a doc_id.
    2. Per bucket (equal band), members are compared with a few pivots by
       estimate; the two likeliest are verified on the full sets; verified links
       are grouped by union-find within tasks, then by contraction.
    3. Where a bucket still holds members of different components, those outside
       its largest component are compared exactly with all others that are
       likely, in blocks of bounded size, so that no link that could join
       components is left out.

    ``group`` is the component's number, null for the empty set. Null text and
    text without words: empty set, alone in its component. A null doc_id stands
    alone with a null component and isn't kept. Repeated rows (of one doc_id)
    have equal sets and share their component; different texts under one doc_id
    are members of their own, and each may be linked. Empty table: empty result.
    Very long texts are hashed whole, one at a time. Other columns are not read.
    """
    texts = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    prints = stored(fingerprints(texts, rule), "dup_prints")
    whole = prints.where("same is not null and doc_id is not null")
    reps = stored(whole.groupBy("same").agg(F.min(F.struct("row", "n", "sig", "bands")).alias("r"), F.min("doc_id").alias("least"))
                  .select("same", F.col("r.row").alias("id"), "least", "r.n", "r.sig", "r.bands"), "dup_classes")
    banded = reps.select("id", "n", F.explode("bands").alias("key"))
    buckets = stored(banded.groupBy("key").agg(F.count("*").alias("held"), F.sum("n").alias("size")).where("held > 1").select(
        "key", F.greatest(F.ceil(F.col("held") / BLOCK), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("long").alias("blocks")), "dup_buckets")
    # most keys are held once: the filter leaves them where they are
    banded = stored(filtered(banded, buckets, "key").where("likely").join(buckets, "key").select("key", "id", "n", "blocks"), "dup_banded")
    members = stored(compared(banded, reps, rule), "dup_members")
    pair = members.select("id", F.explode(F.array("one", "two")).alias("p")).where("p is not null")
    tries = stored(pair.select(F.least("id", "p").alias("u"), F.greatest("id", "p").alias("v")).distinct(), "dup_tries")
    ends = tries.select(F.col("u").alias("row")).union(tries.select("v"))
    sets = stored(shingle_table(texts, ends.distinct(), rule), "dup_sets")
    links = stored(verified(tries, sets, rule), "dup_links")
    comps = components(links, "dup_groups", contract)
    marked = members.join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    open_ = stored(open_members(marked, reps, rule), "dup_open")
    if not open_.isEmpty():
        more = shingle_table(texts, open_.select(F.col("id").alias("row")).distinct(), rule)
        links = stored(links.union(closing_links(open_, more, rule)), "dup_all_links")
        comps = components(links, "dup_final", contract)
    # one row per class, the least doc_id of each group, then back to the documents by the class
    classes = reps.select("same", "id", "least").join(comps.withColumnRenamed("node", "id"), "id", "left").select("same", "least", F.coalesce("component", "id").alias("group"))
    least = classes.groupBy("group").agg(F.min("least").alias("component"))
    out = prints.select("row", "doc_id", "n", "same").join(classes.join(least, "group").select("same", "group", "component"), "same", "left")
    out = out.withColumn("group", F.when(F.col("doc_id").isNotNull(), F.col("group")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "group")


def op8_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents")).drop("row", "group")


def stage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, rule: Rule = STAGE_RULE) -> DataFrame:
    """One document of each group stays: its row of the smallest doc_id. Of texts without words one row per doc_id
    stays, and all rows without doc_id do."""
    rows = numbered(docs)
    found = stored(row_groups(rows, rule), "dup_rows")
    first = lambda by, where: found.where(where).groupBy(by).agg(F.min(F.struct("doc_id", "row")).alias("m")).select("m.row")
    keep = first("group", "group is not null").union(first("doc_id", "group is null and doc_id is not null")).union(found.where("doc_id is null").select("row"))
    gone = stored(found.select("row").join(keep, "row", "left_anti"), "dup_gone")
    marked = filtered(rows, gone, "row")      # what is surely not gone need not move
    left = marked.where("not likely").unionByName(marked.where("likely").join(gone, "row", "left_anti"))
    return left.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


#: All pairs that share a shingle, compared on their full sets; smallest doc_id reachable in a recursive query.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM w, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, m.c AS component_id, m.doc_id = m.c AS kept
FROM m LEFT JOIN n ON m.doc_id = n.doc_id
"""
