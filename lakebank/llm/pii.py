"""Personal data: exact patterns, and identifiers found by bootstrapped contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.llm.common import stored, table

#: Fixed kinds in order, each as leftmost non-overlapping matches. Possessive runs
#: and the look-behinds (a match can only begin where its run begins) find the same
#: matches as the plain patterns, in linear time and constant stack.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Stands for the characters of a fixed kind's match where other identifiers are looked for.
MASK = "\ue000"
#: What may stand in the slot of a context: digit groups joined by single blanks, brackets or
#: signs, or a run that holds a digit or an at sign. No upper length.
SHAPE = (r"(?<![\p{L}\p{N}@._/+\x{E000}-])(?:\(?\+?[0-9][0-9()./+-]*+(?:\x20\(?[0-9][0-9()./+-]*+)++(?![\p{L}@_\x{E000}])"
         r"|\([0-9]++\)[0-9./+-]*+(?![\p{L}@_\x{E000}])|[\p{L}._/+-]*+[0-9@\x{E000}][\p{L}\p{N}@._/+\x{E000}-]*+)")
#: Least letters and digits of an identifier; characters that a context looks at on either side.
LEAST, AROUND = 4, 160
IP_PART = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

#: Rounds of scoring; least summed score and confidence of a pattern; least score of a value.
ROUNDS, SUPPORT, CONFIDENCE, ACCEPT = 3, 3.0, 0.6, 0.8

SPAN = "array<struct<start:int,stop:int,hit:string,before:string,after:string>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (an expression inside a lambda is computed per element)."""
    return F.transform(F.array(value), body)[0]


def spans(text: Column, pattern: str, valid, contexts: bool = False) -> Column:
    """Places of the pattern's valid matches in code points, stop exclusive; with ``contexts`` also what stands about them.

    Starts are summed lengths of the pieces between matches, over runs of about
    the root of their number, first the runs' sums and then each run from its
    own start: arrays that grow stay short, so a text with very many matches
    costs little more than its length.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.lit(None).cast("string")
    columns = [F.transform(F.slice(gaps, F.lit(1), F.size(hits)), F.length).alias("gap"), hits.alias("hit")]
    if contexts:
        before = F.zip_with(F.concat(F.array(F.lit("")), F.slice(hits, F.lit(1), F.greatest(F.size(hits) - 1, F.lit(0)))), F.slice(gaps, F.lit(1), F.size(hits)),
                            lambda hit, gap: F.right(F.concat(hit, gap), F.lit(AROUND)))
        after = F.zip_with(F.slice(gaps, F.lit(2), F.size(hits)), F.concat(F.slice(hits, F.lit(2), F.size(hits)), F.array(F.lit(""))),
                           lambda gap, hit: F.left(F.concat(gap, hit), F.lit(AROUND)))
        columns += [before.alias("before"), after.alias("after")]
    pairs = F.arrays_zip(*columns)

    def add(acc, x):
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), stop.alias("stop"), x["hit"].alias("hit"),
                       (x["before"] if contexts else none).alias("before"), (x["after"] if contexts else none).alias("after"))
        more = F.when(valid(x["hit"]), F.concat(acc["out"], F.array(one)).cast(SPAN)).otherwise(acc["out"])
        return F.struct(stop.alias("at"), more.alias("out"))

    def placed(runs):
        long = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda acc, x: acc + x["gap"] + F.length(x["hit"])))
        begin = F.aggregate(long, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(runs, F.slice(begin, F.lit(1), F.size(runs)), lambda run, at: F.aggregate(
            run, F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")), add, lambda acc: acc["out"])))

    def cut(p, size):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / size).cast("int")), lambda j: F.slice(p, j * size + 1, size))

    found = let(pairs, lambda p: let(F.ceil(F.sqrt(F.size(p))).cast("int"), lambda size: let(cut(p, size), placed)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def masked(text: Column, pattern: str, valid) -> Column:
    """``text`` with MASK for every character of a valid match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.transform(hits, lambda h: F.when(valid(h), F.repeat(F.lit(MASK), F.length(h))).otherwise(h))
    parts = F.zip_with(F.split(text, pattern, -1), F.concat(held, F.array(F.lit(""))), lambda gap, hit: F.concat(gap, hit))
    return F.when(text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


#: Which matches count.
VALID = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: hit.rlike(f"^{IP_PART}(\\.{IP_PART}){{3}}$"),
    "card": lambda hit: F.call_function("luhn_check", digits(hit)),
    "phone": lambda hit: F.length(digits(hit)).between(9, 15),
}


def labelled(kind: str) -> Column:
    """(start, stop, hit, before, after, kind) of a fixed kind's spans."""
    return F.transform(f"_{kind}", lambda x: F.struct(x["start"], x["stop"], x["hit"], x["before"], x["after"], F.lit(kind).alias("kind")))


def places(kind: str) -> Column:
    """(start, stop) of the spans of ``more`` that are of this kind."""
    return F.transform(F.filter("more", lambda x: x["kind"] == kind), lambda x: F.struct(x["start"], x["stop"]))


def with_base(docs: DataFrame, contexts: bool = False) -> DataFrame:
    """Adds _text (null: empty), _key (the text's hash) and one span list per fixed kind."""
    out = docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_key", F.md5(F.col("_text").cast("binary")))
    for kind, pattern in KINDS.items():
        out = out.withColumn(f"_{kind}", spans(F.col("_text"), pattern, VALID[kind], contexts))
    return out


def instances(based: DataFrame) -> DataFrame:
    """(key, start, stop, kind or null, value, pattern): every fixed match and whatever else may be
    an identifier, once per lexical pattern about it. Copies of a text count once.

    Fixed matches are masked where the others are looked for, and a run that
    touches one is left out. The context is what stands between a match and its
    neighbours of the same search, and the neighbour itself, AROUND characters at most.
    """
    base = F.concat(*map(labelled, KINDS))
    full = "array<struct<start:int,stop:int,hit:string,before:string,after:string,kind:string>>"
    text = F.col("_text")
    for kind, pattern in KINDS.items():
        text = F.when(F.size(f"_{kind}") > 0, masked(text, pattern, VALID[kind])).otherwise(text)
    rows = based.select("_key", base.cast(full).alias("base"), text.alias("_masked"))
    edge = r"[^\p{L}\p{N}]"
    first = lambda h: F.when(h.contains(")"), F.regexp_extract(h, r"^[^\p{L}\p{N}(]*", 0)).otherwise(F.regexp_extract(h, rf"^{edge}*", 0))
    lead = lambda h: F.length(first(h))
    tail = lambda h: F.length(F.regexp_extract(h, rf"{edge}*$", 0))
    real = lambda h: ~h.contains(MASK) & (F.length(F.regexp_replace(h, edge, "")) >= LEAST)
    shaped = F.transform(spans(F.col("_masked"), SHAPE, real, True), lambda x: F.struct(
        (x["start"] + lead(x["hit"])).alias("start"), (x["stop"] - tail(x["hit"])).alias("stop"),
        F.substring(x["hit"], lead(x["hit"]) + 1, F.length(x["hit"]) - lead(x["hit"]) - tail(x["hit"])).alias("hit"),
        F.concat(x["before"], F.left(x["hit"], lead(x["hit"]))).alias("before"), F.concat(F.right(x["hit"], tail(x["hit"])), x["after"]).alias("after"),
        F.lit(None).cast("string").alias("kind")))
    rows = rows.select("_key", "base", shaped.cast(full).alias("shaped"))
    rows = rows.select("_key", F.explode(F.concat("base", "shaped")).alias("x")).select("_key", "x.start", "x.stop", "x.kind", F.lower("x.hit").alias("value"),
                                                                                    F.lower("x.before").alias("before"), F.lower("x.after").alias("after"))
    word = r"[^\x20\x09-\x0D]"
    left2 = F.regexp_extract("before", rf"({word}+[\x20\x09-\x0D]+{word}+)[\x20\x09-\x0D]*[\"'(\[<]*$", 1)
    left1 = F.regexp_extract("before", rf"({word}+)[\x20\x09-\x0D]*$", 1)
    right1 = F.regexp_extract("after", rf"^{word}*[\x20\x09-\x0D]+({word}+)", 1)
    tidy = lambda c: F.regexp_replace(c, r"[\x20\x09-\x0D]+", " ")
    patterns = F.array(F.when(left2 != "", F.concat(F.lit("left "), tidy(left2))),
                       F.when((left1 != "") & (right1 != ""), F.concat(F.lit("around "), left1, F.lit(" _ "), right1)))
    return (rows.withColumn("pattern", F.explode(F.filter(patterns, lambda p: p.isNotNull())))
            .select("_key", "start", "stop", "kind", "value", "pattern").distinct())


def bootstrap(found: DataFrame, rounds: int = ROUNDS, support: float = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPT) -> DataFrame:
    """(value, kind) of the identifiers that high-confidence contexts reveal.

    The graph joins patterns and values. Known values score 1. Per round, a
    pattern's confidence for a kind is its values' summed score over the number
    of its values plus one, and it is trusted from ``support`` and
    ``confidence`` on; a value's score is the chance that at least one of its
    trusted patterns is right. Sums are combined before the shuffle, so a
    pattern with a third of all values does not meet in one task.
    """
    edges = stored(found.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii_edges")
    seeds = edges.where("kind is not null").groupBy("value").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0))
    unknown = edges.join(seeds.select("value"), "value", "left_anti").select("pattern", "value")
    spread = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    scores = seeds
    for _ in range(rounds):
        sums = edges.select("pattern", "value").join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
        trusted = (sums.where(F.col("sum") >= support).join(spread, "pattern")
                   .withColumn("conf", F.col("sum") / (F.col("n") + 1)).where(F.col("conf") >= confidence))
        new = (unknown.join(trusted, "pattern").groupBy("value", "kind")
               .agg((1 - F.exp(F.sum(F.log1p(-F.col("conf"))))).alias("score")))
        new = stored(new, "pii_scores")
        scores = seeds.unionByName(new)
    best = new.where(F.col("score") >= accept).groupBy("value").agg(F.max(F.struct("score", "kind")).alias("b"))
    return best.select("value", "b.kind")


def discovered(based: DataFrame) -> DataFrame:
    """(_key, more): spans beyond the fixed kinds, by the text's hash, sorted by start."""
    found = stored(instances(based), "pii_instances")
    hits = bootstrap(found)
    places = found.where("kind is null").select("_key", "start", "stop", "value").distinct().join(hits, "value")
    return places.groupBy("_key").agg(F.sort_array(F.collect_set(F.struct("start", "stop", "kind"))).alias("more"))   # of one text


def named(kind: str, col: Column) -> Column:
    return F.transform(col, lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["stop"]))


def find(docs: DataFrame) -> DataFrame:
    """Per document: counts of the fixed kinds, base_sha256 over their spans, and all spans as text.

    Built-in expressions only. Fixed kinds are found in the row; the contexts
    are scored over the whole corpus, and what they reveal joins back by the
    text's hash, without moving texts. Null text is empty: no spans. Very long
    texts are searched whole. Equal texts get equal spans. An identifier of fewer
    than LEAST letters and digits, one without a digit or an at sign, and one
    that touches a fixed match are not discovered. Empty table: empty result. Clashing extra columns are not read.
    """
    based = with_base(docs.select("doc_id", "text"))
    own = stored(based.select("doc_id", "_key", *[F.transform(f"_{k}", lambda x: F.struct(x["start"], x["stop"])).alias(f"_{k}") for k in KINDS]), "pii_base")
    more = stored(discovered(with_base(docs.select("text"), contexts=True)), "pii_more")
    base = F.concat(*[named(k, F.col(f"_{k}")) for k in KINDS])
    both = F.concat(*[named(k, F.array_sort(F.concat(f"_{k}", places(k)))) for k in KINDS])
    out = own.join(more, "_key", "left").withColumn("more", F.coalesce("more", F.array().cast("array<struct<start:int,stop:int,kind:string>>")))
    return out.select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"), F.concat_ws(",", both).alias("spans"),
                      F.size("more").cast("long").alias("n_discovered"))


def op2_context_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans as one. Null texts stay null."""
    based = with_base(docs.select(F.struct("*").alias("_doc"), "text"))
    # written first, so that the planner knows its size before it decides whether texts must move
    more = stored(discovered(with_base(docs.select("text"), contexts=True)), "pii_more")
    listed = "array<struct<start:int,stop:int,kind:string>>"
    spans_ = F.concat(*[F.transform(labelled(k), lambda x: F.struct(x["start"], x["stop"], x["kind"])) for k in KINDS],
                      F.coalesce("_more", F.array().cast(listed)))
    out = based.join(more.select(F.col("_key").alias("_of"), F.col("more").alias("_more")), F.col("_key") == F.col("_of"), "left")
    out = out.withColumn("_spans", F.array_sort(spans_))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(acc, x):
        gap = F.substring(F.col("_text"), acc["at"] + 1, x["start"] - acc["at"])
        fresh = x["start"] >= acc["at"]
        parts = F.when(fresh, F.concat(acc["parts"], F.array(gap, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), parts.alias("parts"))

    tail = lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(F.col("_text"), acc["at"] + 1, F.length("_text")))
    clean = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, cut, tail)).otherwise(F.col("_text"))
    return out.withColumn("_clean", F.when(F.col("text").isNotNull(), clean)).select(
        *[F.col("_clean").alias(c) if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)
