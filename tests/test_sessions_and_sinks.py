"""Session expiry, TTL cache, table sink metadata and bucketing."""
import datetime as dt

from pyspark.sql import functions as F

from lakebank.operators import sessions
from lakebank.session import scratch_path
from lakebank.sources.sinks import checkpoint_table, save_table, write_partitioned

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def _t(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_session_ttl_gap_and_logout(spark):
    rows = [(1, _t(0), "view"), (1, _t(29), "view"), (1, _t(59), "view"),    # 30 min gap exactly -> new session
            (1, _t(60), "error"), (1, _t(61), "view"),                      # logout ends at once
            (2, _t(0), "view")]
    e = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "event_id long, user_id long, ts timestamp_ntz, event_type string")
    s = sessions.session_ttl(e, "user_id", "ts", "event_id", 1800, logout=F.col("event_type") == "error").orderBy(
        "user_id", "session_no").collect()
    got = [(r["user_id"], r["n_events"], r["ended_by"], r["expires_at"]) for r in s]
    assert got == [(1, 2, "ttl", _t(59)), (1, 2, "logout", _t(60)), (1, 1, "ttl", _t(91)), (2, 1, "ttl", _t(30))]


def test_session_ttl_ties_and_null_users(spark):
    """Events of one instant go by id, and a null user is a user like any other, whatever the buckets."""
    rows = [(1, 7, _t(0), "view"), (3, 7, _t(5), "view"), (2, 7, _t(5), "error"), (4, None, _t(0), "view"), (5, None, _t(20), "view"), (6, None, _t(45), "view")]
    for order in (rows, rows[::-1]):
        e = spark.createDataFrame(order, "event_id long, user_id long, ts timestamp_ntz, event_type string")
        for bucket in (600, 86400):
            s = sessions.session_ttl(e, "user_id", "ts", "event_id", 1800, F.col("event_type") == "error", bucket)
            got = sorted(((r["user_id"], r["n_events"], r["ended_by"]) for r in s.collect()), key=str)
            assert got == [(7, 1, "ttl"), (7, 2, "logout"), (None, 3, "ttl")]


def test_ttl_lookup_ties_go_by_id(spark):
    rows = [(1, "C1", "cards", _t(0), "put"), (2, "C1", None, _t(0), "invalidate"), (3, "C1", "cards", _t(0), "put"), (4, "C1", "cards", _t(1), "request"),
            (5, None, "cards", _t(0), "put"), (6, None, "cards", _t(3), "request")]
    ce = spark.createDataFrame(rows, "event_id long, customer_id string, data_type string, ts timestamp_ntz, kind string")
    hits = {r["event_id"]: r["hit"] for r in sessions.ttl_lookup(ce, ["cards"], 300, bucket_seconds=60).collect()}
    assert hits == {4: True, 6: True}


def test_ttl_lookup_hit_expiry_and_invalidation(spark):
    rows = [(1, "C1", "balance", _t(0), "put"), (2, "C1", "balance", _t(3), "request"),
            (3, "C1", "balance", _t(6), "request"),                                   # 6 min > 300 s TTL
            (4, "C1", "cards", _t(10), "put"), (5, "C1", None, _t(11), "invalidate"),
            (6, "C1", "cards", _t(12), "request"), (7, "C1", "cards", _t(13), "put"),
            (8, "C1", "cards", _t(14), "request"), (9, "C2", "cards", _t(14), "request")]
    ce = spark.createDataFrame(rows, "event_id long, customer_id string, data_type string, ts timestamp_ntz, "
                                     "kind string")
    hits = {r["event_id"]: r["hit"] for r in sessions.ttl_lookup(ce, ["balance", "cards", "loans"], 300).collect()}
    assert hits == {2: True, 3: False, 6: False, 8: True, 9: False}


def test_prompt_assembly_adds_system_only_on_empty_history(spark):
    rows = [("s", 0, "user", "hola"), ("s", 1, "assistant", "buenas"), ("s", 2, "user", "saldo?")]
    m = spark.createDataFrame(rows, "session_id string, turn long, role string, text string")
    r = sessions.prompt_assembly(m).orderBy("turn").collect()
    assert [(x["n_prior"], x["system_added"], x["prompt_size"]) for x in r] == [(0, True, 2), (2, False, 3)]
    assert "Sin contexto adicional disponible." in r[0]["system_text"]


def test_save_table_properties_and_bucketing(spark):
    df = spark.range(100).select(F.col("id").alias("cuenta_id"), (F.col("id") % 3).alias("p"))
    save_table(df, "t_bucketed", partition_cols=["p"], comment="gold table",
               properties={"quality": "gold"}, bucket_by=(4, "cuenta_id"))
    props = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES t_bucketed").collect()}
    assert props.get("quality") == "gold"
    assert spark.table("t_bucketed").count() == 100
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("t_bucketed").join(spark.table("t_bucketed").withColumnRenamed("p", "q"), "cuenta_id")
        assert j.count() == 100
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan   # co-located by buckets
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_partitioned_write_and_checkpoint_table(spark):
    df = spark.range(50).select("id", (F.col("id") % 5).alias("m"))
    path = write_partitioned(df, scratch_path(spark, "t"), ["m"])
    back = spark.read.parquet(path)
    assert back.filter("m = 3").count() == 10
    assert checkpoint_table(df).count() == 50


def test_prompt_assembly_uses_the_trimmed_history(spark):
    rows = [("s", 0, "system", "sys")]
    for i in range(15):
        rows += [("s", 1 + 2 * i, "user", f"q{i}"), ("s", 2 + 2 * i, "assistant", f"a{i}")]
    m = spark.createDataFrame(rows, "session_id string, turn long, role string, text string")
    r = {x["turn"]: x["n_prior"] for x in sessions.prompt_assembly(m, cap=20).collect()}
    assert r[1] == 1 and r[19] == 19                 # up to the cap: whole history
    assert r[29] == 1 + 19                           # past it: system + last 19 others


def test_table_comment_with_quotes(spark):
    from lakebank.sources.sinks import save_table
    save_table(spark.range(3).toDF("k"), "quoted_comment", comment="the bank's \\ table")
    assert spark.catalog.getTable("quoted_comment").description == "the bank's \\ table"
    spark.sql("DROP TABLE quoted_comment")
