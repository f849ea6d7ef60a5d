"""Merkle manifest of a data set: nodes labelled by the intervals of leaf ranks that they cover."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.llm.common import ascii_lower, running_total, stored, table

#: Nodes of a run, which become one node of the level above.
FAN = 16
#: Levels whose nodes are joined by buckets of their own width; nodes above are dealt to buckets of the last one.
BUCKET_LEVELS = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_CHAIN = "array<struct<level:int,left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def cut(col: str, level: Column | int, fan: int) -> Column:
    """Number of the bucket of ``fan ** level`` ranks that holds ``col``."""
    return F.floor(F.col(col) / F.lit(fan**level)).cast("long")


def joined(nodes: Column) -> Column:
    return F.concat_ws("", F.transform(nodes, lambda c: c["digest"]))


def runs(leaves: DataFrame, fan: int) -> DataFrame:
    """(tree, size, lo, hi, members) from (tree, size, rank, digest, item): the lowest nodes with their leaves in order. A run has ``fan`` leaves at most."""
    members = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "item")))
    out = leaves.groupBy("tree", "size", cut("rank", 1, fan).alias("run")).agg(members.alias("members"))
    return out.select("tree", "size", F.col("members")[0]["lo"].alias("lo"), F.element_at("members", -1)["hi"].alias("hi"), "members")


def levels(lowest: DataFrame, fan: int, name: str) -> list[DataFrame]:
    """Nodes (tree, size, lo, hi, level, digest, children) of every level above the leaves.

    A node covers the leaf ranks lo to hi - 1 of its tree. A tree grows while it
    has several nodes on its uppermost level; each level is a ``fan``-th of the
    one below, so all of them are small beside the leaves. Only the size of the
    largest tree reaches the driver.
    """
    largest = lowest.agg(F.max("size")).head()[0] or 0
    children = lambda c: F.transform(c, lambda m: F.struct(m["lo"].alias("lo"), m["hi"].alias("hi"), m["digest"].alias("digest")))
    node = lowest.where("size > 1").select("tree", "size", "lo", "hi", F.lit(1).alias("level"), children(F.col("members")).alias("children"))
    out = []
    while largest > fan**len(out):
        out.append(stored(node.withColumn("digest", F.sha2(joined(F.col("children")), 256)), name))
        below, level = out[-1].where(F.col("size") > fan**len(out)), len(out) + 1
        node = (below.groupBy("tree", "size", cut("lo", level, fan).alias("run"))
                .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
                .select("tree", "size", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), F.lit(level).alias("level"), "children"))
    return out


def siblings(nodes: Column, lo: Column, level: Column) -> Column:
    """What stands before and after rank ``lo``'s own node among ``nodes``: their intervals less the one that holds it."""
    return F.struct(level.cast("int").alias("level"),
                    joined(F.filter(nodes, lambda c: c["hi"] <= lo)).alias("left"),
                    joined(F.filter(nodes, lambda c: c["lo"] > lo)).alias("right"))


def with_chains(lowest: DataFrame, nodes: list[DataFrame], fan: int) -> DataFrame:
    """``lowest`` and chain: the siblings on every level above the run, lowest first.

    Ancestors are the nodes whose interval contains the run's. Runs meet them by
    level and bucket: up to BUCKET_LEVELS a node lies in the bucket of its own
    width; wider nodes are dealt to all buckets of the last width that they
    cover. A bucket thus has ``fan ** BUCKET_LEVELS`` leaves and a few nodes,
    also in a tree that holds a third of all leaves.
    """
    if len(nodes) < 2:
        return lowest.withColumn("chain", F.array().cast(_CHAIN))
    dealt = []
    for level, node in enumerate(nodes[1:], 2):
        at = min(level, BUCKET_LEVELS)
        buckets = F.sequence(cut("lo", at, fan), F.floor((F.col("hi") - 1) / F.lit(fan**at)).cast("long"))
        dealt.append(node.select("tree", F.lit(at).alias("at"), F.explode(buckets).alias("bucket"), "level",
                                 F.col("lo").alias("first"), F.col("hi").alias("end"), "children"))
    above = reduce(DataFrame.unionByName, dealt)
    keys = F.array(*[F.struct(F.lit(at).alias("at"), cut("lo", at, fan).alias("bucket")) for at in range(2, BUCKET_LEVELS + 1)])
    probes = lowest.where(F.col("size") > fan).select("tree", "lo", "hi", F.explode(keys).alias("k")).select("tree", "lo", "hi", "k.at", "k.bucket")
    found = (probes.join(above, ["tree", "at", "bucket"]).where("first <= lo and hi <= end")
             .select("tree", "lo", siblings(F.col("children"), F.col("lo"), F.col("level")).alias("step")))
    chains = found.groupBy("tree", "lo").agg(F.array_sort(F.collect_list("step")).alias("chain"))
    return lowest.join(chains, ["tree", "lo"], "left").withColumn("chain", F.coalesce("chain", F.array().cast(_CHAIN)))


def member_paths(chained: DataFrame, *keep: str) -> DataFrame:
    """(tree, size, member, path): every leaf with the siblings of all levels."""
    out = chained.select("tree", "size", "members", "chain", *keep, F.explode("members").alias("member"))
    own = F.when(F.col("size") > 1, F.array(siblings(F.col("members"), F.col("member")["lo"], F.lit(1)))).otherwise(F.array().cast(_CHAIN))
    return out.select("tree", "size", "member", F.concat(own, "chain").alias("path"), *keep)


def folded(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame, altered: Column, fan: int = FAN) -> DataFrame:
    """Every document's leaf, subroot, root, proof and the root folded from ``altered`` (a leaf digest) and the proof.

    Per source, leaves ascend by doc_id (null first; equal doc_ids by digest; rows
    alike in all fields are interchangeable), and every ``fan`` of them become a
    node, level by level, up to the source's subroot; subroots in order of source
    (null first, bytewise) likewise give the root. Ranks come from one
    range-partitioned sort, so a source with a third of all rows is split over
    tasks. Then nothing larger than a digest per document moves, and the siblings
    are gathered per run of ``fan`` documents, never per document. Only the root
    and two sizes reach the driver.

    Null fields count as such in the digest; long texts are hashed whole, in the
    scan. One document: leaf, subroot and root are one, the proof has no sibling.
    Empty table: empty result. Other columns are not read.
    """
    prefixed = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    leaves = docs.select(prefixed.alias("tree"), "doc_id", leaf_digest().alias("digest"), altered.alias("altered"), F.lit(1).alias("one"),
                         F.monotonically_increasing_id().alias("tie"))
    ranked = running_total(leaves, "tree", ["doc_id", "digest", "tie"], "one", "manifest_leaves")
    ranked = ranked.select("tree", F.col("whole").alias("size"), F.col("before").alias("rank"), "digest", F.struct("doc_id", "altered").alias("item"))
    lowest = stored(runs(ranked, fan), "manifest_runs")
    nodes = levels(lowest, fan, "manifest_nodes")

    lone = lowest.where("size = 1").select("tree", "size", F.col("members")[0]["digest"].alias("digest"))
    whole = reduce(DataFrame.unionByName, [n.where("lo = 0 and hi = size").select("tree", "size", "digest") for n in nodes], lone)
    order = whole.select(F.col("tree").alias("source"), F.col("size").alias("held"), "digest", F.lit("").alias("tree"), F.lit(1).alias("one"))
    order = running_total(order, "tree", ["source"], "one", "manifest_sources")
    sources = stored(runs(order.select("tree", F.col("whole").alias("size"), F.col("before").alias("rank"), "digest",
                                       F.struct("source", "held").alias("item")), fan), "manifest_source_runs")
    upper = levels(sources, fan, "manifest_upper")
    top = upper[-1] if upper else whole
    root = top.select("digest").head()
    tops = member_paths(with_chains(sources, upper, fan)).select(
        F.col("member")["item"]["source"].alias("tree"), F.col("member")["digest"].alias("subroot"), F.col("path").alias("upper"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("member")["item"]["held"] - 1) / F.lit(fan**BUCKET_LEVELS)).cast("long"))).alias("bucket"))
    # a source's path goes to each of its buckets: no key is hotter than a bucket
    chained = with_chains(lowest, nodes, fan).withColumn("bucket", cut("lo", BUCKET_LEVELS, fan)).join(tops, ["tree", "bucket"])
    paths = member_paths(chained, "subroot", "upper").withColumn("path", F.concat("path", "upper"))
    siblings_of = F.concat_ws("", F.transform("path", lambda s: F.concat(s["left"], s["right"])))
    out = paths.select(F.col("member")["item"]["doc_id"].alias("doc_id"), F.col("member")["digest"].alias("leaf"), "subroot",
                       F.lit(root[0] if root else None).cast("string").alias("root"), F.sha2(siblings_of, 256).alias("proof_sha256"),
                       folded(F.coalesce(F.col("member")["item"]["altered"], F.col("member")["digest"]), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    return manifest(docs, F.when(tampered, leaf_digest(text=ascii_lower(F.col("text")))))


def _oracle(own: int = 5, upper: int = 4) -> str:
    """The same tree level by level: up to 16 ** own documents of a source and 16 ** upper sources."""
    def field_sql(c: str, value: str | None = None) -> str:
        value = f"({value or c})::varchar"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def growth(name: str, base: str, depth: int) -> str:
        out = [f"{name}0 AS (SELECT k, n, r AS p, h FROM {base})"]
        for i in range(1, depth + 1):
            out.append(f"{name}{i} AS (SELECT k, n, p // 16 AS p, sha256(string_agg(h, '' ORDER BY p)) AS h FROM {name}{i - 1} "
                       f"WHERE n > {16 ** (i - 1)} GROUP BY k, n, p // 16)")
        tops = " UNION ALL ".join(f"SELECT k, n, h FROM {name}{i} WHERE n <= {16 ** i}" + (f" AND n > {16 ** (i - 1)}" if i else "") for i in range(depth + 1))
        return ",\n".join([*out, f"{name}_top AS ({tops})"])

    def steps(name: str, prior: str, depth: int, k: str, r: str) -> str:
        out = []
        for i in range(depth):
            out.append(
                f"{name}_f{i + 1} AS (SELECT f.* EXCLUDE (acc, sib), "
                f"CASE WHEN s.n > {16 ** i} THEN sha256(coalesce(s.a, '') || f.acc || coalesce(s.b, '')) ELSE f.acc END AS acc, "
                f"f.sib || coalesce(s.a, '') || coalesce(s.b, '') AS sib FROM {prior} f JOIN ("
                f"SELECT m.k, m.n, m.p, string_agg(o.h, '' ORDER BY o.p) FILTER (WHERE o.p < m.p) AS a, string_agg(o.h, '' ORDER BY o.p) FILTER (WHERE o.p > m.p) AS b "
                f"FROM {name}{i} m JOIN {name}{i} o ON o.k = m.k AND o.p // 16 = m.p // 16 GROUP BY ALL"
                f" UNION ALL SELECT k, n, 0, NULL, NULL FROM {name}_top WHERE {16 ** (i - 1) if i else 0} >= n) s"
                f" ON s.k = f.{k} AND s.p = CASE WHEN {16 ** (i - 1) if i else 0} >= s.n THEN 0 ELSE f.{r} // {16 ** i} END)")
            prior = f"{name}_f{i + 1}"
        return ",\n".join(out)

    leaf = " || ".join(field_sql(c) for c in FIELDS)
    lower = " || ".join(field_sql(c, "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if c == "text" else None) for c in FIELDS)
    return rf"""
WITH RECURSIVE crc_table(i, k, c) AS (
  SELECT i::bigint, 0, i::bigint FROM range(256) AS t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8),
crc(id, i, c) AS (
  SELECT DISTINCT doc_id, 0, 4294967295::bigint FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT id, crc.i + 1, xor(t.c, crc.c >> 8)
  FROM crc JOIN crc_table t ON t.k = 8 AND t.i = (xor(crc.c, ascii(substr(id::varchar, crc.i + 1, 1))::bigint) & 255)
  WHERE crc.i < length(id::varchar)),
hit AS (SELECT id FROM crc WHERE i = length(id::varchar) AND xor(c, 4294967295) % 5 = 0),
d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS k, sha256({leaf}) AS h,
             CASE WHEN doc_id IN (SELECT id FROM hit) THEN sha256({lower}) ELSE sha256({leaf}) END AS t FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS r, count(*) OVER (PARTITION BY k) AS n FROM d),
{growth("a", "l", own)},
src AS (SELECT '' AS k, a_top.k AS source, h, row_number() OVER (ORDER BY encode(a_top.k)) - 1 AS r, count(*) OVER () AS n FROM a_top),
{growth("b", "src", upper)},
a_f0 AS (SELECT l.doc_id, l.k, l.r, l.h AS leaf, src.h AS subroot, '' AS one, src.r AS sr, l.t AS acc, '' AS sib FROM l JOIN src ON src.source = l.k),
{steps("a", "a_f0", own, "k", "r")},
{steps("b", f"a_f{own}", upper, "one", "sr")}
SELECT doc_id, leaf, subroot, b_top.h AS root, sha256(sib) AS proof_sha256, acc AS folded_root, acc = b_top.h AS verified
FROM b_f{upper}, b_top
"""


ORACLE = _oracle()
