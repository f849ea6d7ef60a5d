"""Chat sessions as tables: history trim and load, prompt assembly, session
expiry and the keyed TTL cache lookup (W3, I3-I6).

The reference keeps one session's history in a key-value store and applies
these rules one request at a time; here they run over a whole message or
event log. Per-key ordered scans use ``ordered`` so a hot session, customer
or key is split over time buckets instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakebank.functions.expr import instant_to_ntz, ntz_to_instant
from lakebank.operators.ordered import BUCKET, KEY, _bucketed, block_bucket, running, time_bucket

# Fixed values from the reference.
HISTORY_CAP = 20
SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
LOADED_ROLES = (SYSTEM, USER, ASSISTANT)
SESSION_TTL_SECONDS = 1800
BANKING_DATA_TTL_SECONDS = 300
NO_CONTEXT = "Sin contexto adicional disponible."
SYSTEM_PROMPT = """Eres un asistente bancario virtual inteligente del banco.
Ayudas a los clientes con consultas sobre sus productos digitales:
  - Tarjetas de crédito digitales
  - Cuentas en soles y dólares
  - Préstamos digitales
  - Transferencias y operaciones

Reglas estrictas:
1. NUNCA inventes saldos, tasas ni datos financieros. Usa SIEMPRE las funciones disponibles.
2. Si el cliente pide operaciones (transferencias, pagos), confirma antes de ejecutar.
3. Responde SIEMPRE en el mismo idioma que usa el cliente.
4. Para datos sensibles, muestra solo los últimos 4 dígitos de cuentas/tarjetas.
5. Si detectas actividad sospechosa, escala al equipo humano.
6. Sé conciso, preciso y empático.

Contexto adicional de la base de conocimiento del banco:
{rag_context}
"""
TURN_BLOCK = 1024


def with_session_id(requests: DataFrame, col: str = "session_id") -> DataFrame:
    """Requests without a session id get a new one of their own (a random UUID: write it before it is used twice)."""
    return requests.withColumn(col, F.coalesce(F.col(col), F.uuid()))


def history_trim(messages: DataFrame, cap: int = HISTORY_CAP, key: str = "session_id",
                 order: str = "turn") -> DataFrame:
    """What ``save`` stores. Sessions over ``cap`` messages keep every
    system message plus the last ``cap - 1`` others, of which only user and
    assistant messages survive (other roles count towards the ``cap - 1``).

    Two scans: the sessions' totals (a partial aggregate), and a bucketed running
    count of the other messages; what is left to the end follows from both, so
    one filter decides and a very long session is split over turn blocks.
    ``pos`` is the stored order: system messages first when trimmed.
    """
    role = F.col("role")
    is_system = F.coalesce(role == SYSTEM, F.lit(False))
    other = (~is_system).cast("int")
    totals = messages.groupBy(F.struct(key).alias("__tk")).agg(F.count(F.lit(1)).alias("__n"), F.sum(other).alias("__all"))
    m = running(messages, [key], [order], {"__upto": (other, "sum")}, bucket=block_bucket(order, TURN_BLOCK), keep_bucket=True)
    m = m.join(totals, F.col(KEY) == F.col("__tk"))
    small = F.col("__n") <= cap
    recent = role.isin(USER, ASSISTANT) & (F.col("__all") - F.col("__upto") < cap - 1)
    kept = m.filter(small | is_system | recent).withColumn("__g", (~small & ~is_system).cast("int"))
    pos = F.row_number().over(Window.partitionBy(KEY).orderBy("__g", order))     # over what was kept: cap and the system messages
    return kept.select(*messages.columns, pos.alias("pos"))


def session_history(saved: DataFrame, key: str = "session_id", order: str = "pos") -> DataFrame:
    """On load keep only system / user / assistant messages, in order, as
    ``array<struct<role, text>>``. Input is the trimmed history, so each
    collected list is bounded by the cap."""
    kept = saved.filter(F.col("role").isin(*LOADED_ROLES))
    g = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        F.col(order).alias("o"), F.col("role").alias("role"), F.col("text").alias("text")))).alias("__m"))
    return g.select(key, F.transform("__m", lambda x: F.struct(x["role"].alias("role"),
                                                               x["text"].alias("text"))).alias("messages"))


def prompt_assembly(messages: DataFrame, contexts: DataFrame | None = None, key: str = "session_id",
                    order: str = "turn", cap: int = HISTORY_CAP) -> DataFrame:
    """For every user turn, the prompt sent to the model: the saved and
    loaded history before the turn (``messages``), preceded by the system
    message -- with the retrieved context of ``contexts`` (key, order, context)
    or the fallback -- only when that history is empty, then the turn itself.

    The history is what ``history_trim`` keeps of the earlier messages: all up
    to ``cap``; beyond, the system messages and of the last ``cap - 1`` others
    those of user and assistant. Messages are numbered by bucketed running
    counts, and a turn meets the ``cap`` others before it by equality joins on
    the number, so a long session is not gathered in one task. System messages
    are few per session and uncut, as in the reference.
    """
    role = F.col("role")
    is_system = F.coalesce(role == SYSTEM, F.lit(False))
    m = running(messages, [key], [order], {"__n": (F.lit(1), "sum"), "__other": ((~is_system).cast("int"), "sum")},
                bucket=block_bucket(order, TURN_BLOCK), include_current=False)
    m = m.withColumns({"__n": F.coalesce("__n", F.lit(0)), "__other": F.coalesce("__other", F.lit(0))})
    users = m.filter(role == USER).select(key, order, "text", "__n", "__other")
    ask = users.select(F.col(key).alias("__k"), F.col(order).alias("__at"), "__n", "__other")
    reach = F.when(F.col("__n") <= cap, cap).otherwise(cap - 1)
    # number of each message wanted: the last ``reach`` others before the turn
    wanted = ask.select("__k", "__at", "__n", F.explode(F.when(F.col("__other") > 0, F.sequence(
        F.greatest(F.col("__other") - reach, F.lit(0)), F.col("__other") - 1))).alias("__no"))
    said = m.filter(role.isin(USER, ASSISTANT)).select(F.struct(key).alias("__mk"), "__other", order, "role", "text")
    near = wanted.join(said, (F.struct(F.col("__k").alias(key)) == F.col("__mk")) & (F.col("__no") == F.col("__other")))
    system = m.filter(is_system).select(F.struct(key).alias("__mk"), order, "role", "text")
    above = ask.join(system, (F.struct(F.col("__k").alias(key)) == F.col("__mk")) & (F.col(order) < F.col("__at")))
    line = F.struct((F.col("__n") > cap) & (role != SYSTEM), F.col(order), F.col("role"), F.col("text"))
    cols = [F.col("__k"), F.col("__at"), line.alias("line")]
    prior = (near.select(*cols).unionByName(above.select(*cols)).groupBy(F.struct(F.col("__k").alias(key)).alias("__mk"), "__at")
             .agg(F.sort_array(F.collect_list("line")).alias("__lines")))           # of one turn: cap and the system messages
    users = users.withColumn("__uk", F.struct(key)).join(prior, (F.col("__uk") == F.col("__mk")) & (F.col(order) == F.col("__at")), "left")
    if contexts is not None:
        users = users.join(contexts.select(F.struct(key).alias("__ck"), F.col(order).alias("__ct"), "context"),
                           (F.col("__uk") == F.col("__ck")) & (F.col(order) == F.col("__ct")), "left")
    else:
        users = users.withColumn("context", F.lit(None).cast("string"))
    ctx = F.when(F.coalesce(F.length("context"), F.lit(0)) > 0, F.col("context")).otherwise(F.lit(NO_CONTEXT))
    sys_text = F.replace(F.lit(SYSTEM_PROMPT), F.lit("{rag_context}"), ctx)
    message = lambda r, t: F.struct(r.alias("role"), t.alias("text"))
    history = F.transform(F.coalesce("__lines", F.array()), lambda x: message(x["role"], x["text"]))
    added = F.col("__lines").isNull()
    first = F.when(added, F.array(message(F.lit(SYSTEM), sys_text))).otherwise(history)
    n = F.when(added, 0).otherwise(F.size("__lines")).cast("long")
    return users.select(key, order, n.alias("n_prior"), added.alias("system_added"), (n + 1 + added.cast("long")).alias("prompt_size"),
                        F.when(added, sys_text).alias("system_text"),
                        F.concat(first, F.array(message(F.lit(USER), F.col("text")))).alias("messages"))


def session_ttl(events: DataFrame, key: str, ts: str, id_col: str, ttl_seconds: int = SESSION_TTL_SECONDS,
                logout: F.Column | None = None, bucket_seconds: int = 3600) -> DataFrame:
    """Sessions that expire ``ttl_seconds`` after the last activity (each
    event renews it); a logout event ends its session at once. Events of one
    instant go by ``id_col``.

    One bucketed scan: within a (key, time bucket) the previous event and the
    number of session starts come from one window; one row per bucket with its
    first and last event carries both over to the next buckets.
    """
    ttl = F.lit(ttl_seconds * 1_000_000)
    order = F.struct(ts, id_col)
    lo = F.lit(False) if logout is None else F.coalesce(logout, F.lit(False))
    e = _bucketed(events.withColumn("__logout", lo), [key], time_bucket(ts, bucket_seconds))
    w = Window.partitionBy(KEY, BUCKET).orderBy(ts, id_col)
    e = e.withColumns({"__prev": F.lag(ts).over(w), "__prev_out": F.lag("__logout").over(w)})
    begins = lambda prev, out, now: out | (F.timestamp_diff("MICROSECOND", prev, now) >= ttl)
    # the bucket's first event begins a session as far as the bucket knows; the carry below corrects that
    e = e.withColumn("__start", F.when(F.col("__prev").isNull(), 0).otherwise(
        begins(F.col("__prev"), F.col("__prev_out"), F.col(ts)).cast("int")))
    e = e.withColumn("__no", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    over = Window.partitionBy(KEY).orderBy(BUCKET)
    s = e.groupBy(KEY, BUCKET).agg(F.min(ts).alias("first"), F.max(F.struct(order.alias("o"), "__logout")).alias("last"),
                                   F.sum("__start").alias("starts"))
    before = F.lag("last").over(over)
    s = s.select(KEY, BUCKET, "starts", F.coalesce(begins(before["o"][ts], before["__logout"], F.col("first")), F.lit(True)).cast("int").alias("fresh"))
    s = s.select(KEY, BUCKET, (F.sum(F.col("starts") + F.col("fresh")).over(over) - F.col("starts")).alias("__base"))
    g = (e.join(s, [KEY, BUCKET]).groupBy(key, (F.col("__base") + F.col("__no")).cast("long").alias("session_no"))
         .agg(F.min(ts).alias("started_at"), F.max(ts).alias("last_activity"), F.count(F.lit(1)).alias("n_events"),
              F.max_by("__logout", order).alias("__ended")))
    return g.select(key, "session_no", "started_at", "last_activity", "n_events",
                    F.when(F.col("__ended"), F.lit("logout")).otherwise(F.lit("ttl")).alias("ended_by"),
                    F.when(F.col("__ended"), F.col("last_activity"))
                     .otherwise(F.col("last_activity") + F.make_dt_interval(secs=F.lit(ttl_seconds)))
                     .alias("expires_at"))


def ttl_lookup(cache_events: DataFrame, data_types: Sequence[str], ttl_seconds: int = BANKING_DATA_TTL_SECONDS,
               key: str = "customer_id", type_col: str = "data_type", ts: str = "ts", kind: str = "kind",
               id_col: str = "event_id", bucket_seconds: int = 86400) -> DataFrame:
    """I4: for each ``request`` event, is the cached (customer, type) value
    usable? It is when the newest earlier ``put`` is younger than the TTL
    and no ``invalidate`` of that customer came after it.

    Invalidations carry no type: they are expanded to ``data_types`` (a fixed
    list, so the expansion is bounded). One ordered scan per (customer, type)
    computes running maxima of put and invalidation times.
    """
    types = F.array(*[F.lit(t) for t in data_types])
    k = F.col(kind)
    inv = (cache_events.filter(k == "invalidate")
           .withColumn(type_col, F.explode(types)))
    ev = cache_events.filter(k != "invalidate").unionByName(inv)
    at = F.struct(F.col(ts).alias("t"), F.col(id_col).alias("i"))     # events of one instant go by id
    r = running(ev, [key, type_col], [ts, id_col], {"__put": (F.when(k == "put", at), "max"),
                                                    "__inv": (F.when(k == "invalidate", at), "max")},
                bucket=time_bucket(ts, bucket_seconds))
    age = F.timestamp_diff("MICROSECOND", F.col("__put.t"), F.col(ts))
    hit = (F.col("__put").isNotNull() & (F.col("__inv").isNull() | (F.col("__inv") < F.col("__put")))
           & (age < F.lit(ttl_seconds * 1_000_000)))
    return (r.filter(k == "request")
            .select(id_col, key, type_col, ts, F.col("__put.t").alias("last_put"),
                    F.col("__inv.t").alias("last_invalidation"), hit.alias("hit")))


def session_windows(events: DataFrame, key: str, ts: str, gap_seconds: int = SESSION_TTL_SECONDS, watermark_seconds: int | None = None) -> DataFrame:
    """I3 by Spark's own ``session_window``: key, started_at, last_activity, n_events, expires_at.

    For a batch, or a stream in append mode with ``watermark_seconds``: a session
    then comes out once the watermark has passed its end, its state ends with it,
    and a row later than that joins no session. Partial sessions are merged before
    the shuffle. A null key or time has no session.
    """
    e = events.select(F.col(key), ntz_to_instant(ts).alias("__at")).where(F.col(key).isNotNull() & F.col("__at").isNotNull())
    if watermark_seconds is not None:
        e = e.withWatermark("__at", f"{watermark_seconds} seconds")
    # windows that touch are merged: one microsecond less, so that an event just at the end begins a session
    w = F.session_window("__at", f"{gap_seconds * 1_000_000 - 1} microseconds")
    got = e.groupBy(key, w.alias("__w")).agg(F.max("__at").alias("__last"), F.count("*").alias("n_events"))
    return got.select(key, instant_to_ntz("__w.start").alias("started_at"), instant_to_ntz("__last").alias("last_activity"), "n_events",
                      F.timestamp_add("SECOND", F.lit(gap_seconds), instant_to_ntz("__last")).alias("expires_at"))
