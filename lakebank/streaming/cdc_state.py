"""SCD-2 target kept up by keyed state (I1, A9): a batch costs what it changes, not what the log holds.

``readStream`` of change files -> ``transformWithStateInPandas`` keyed by the
table's key -> ``foreachBatch``. The state of a key holds the places of its
changes: the newest one as a value, all of them as a map. Per micro-batch and key
only these come out:

* every new change, with the time of the change that follows it;
* for a change that now has another follower, its place and that time.

A change behind the newest is the common case and touches the newest place
alone; a late one looks up its neighbours in the map. Both kinds of rows are
appended under their epoch, so a retried epoch replaces its own rows, nothing
that a reader may hold is overwritten, and another job can read the table at any
time. Truncates pass through and are applied when the table is read, by the same
rule as in batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lakebank.functions.expr import _EPOCH_NTZ, epoch_micros
from lakebank.operators.cdc import _payload, close_versions

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EPOCH = "_epoch"
# microseconds and zone are kept, so rows come back from the state operator as they went in
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


class Places(StatefulProcessor):
    """State of one key: where its changes lie in the sequence."""

    def __init__(self, place: T.StructType):
        self.place, self.names = place, place.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.place)
        self.known = handle.getMapState("known", self.place, "one boolean")

    def handleInputRows(self, key, rows, timerValues):
        import bisect

        new: dict = {}
        for pdf in rows:
            pdf.columns = ["__key", *self.names, "__kind", "__row"]     # they come by position
            places = zip(*(pdf[c].tolist() for c in self.names))
            for place, op, row in zip(places, pdf["__kind"].tolist(), pdf["__row"].tolist()):
                if op == "truncate":      # of no key: goes by
                    yield self._frame(key, [place], [None], [op], [row])
                else:
                    new[place] = (op, row)
        if not new:
            return
        newest = tuple(self.newest.get()) if self.newest.exists() else None
        late = newest is not None and min(new) <= newest
        held = sorted(tuple(p) for p in self.known.keys()) if late else [newest] if newest else []
        order = sorted({*held, *new})
        closed = set()
        out: list = [[], [], [], []]
        for place in sorted(new):
            at = bisect.bisect_left(order, place)
            follower = order[at + 1][0] if at + 1 < len(order) else None
            op, row = new[place]
            for column, v in zip(out, (place, follower, op, row)):
                column.append(v)
            before = order[at - 1] if at else None
            if before is not None and before not in new and before not in closed:
                closed.add(before)
                for column, v in zip(out, (before, place[0], "closed", None)):
                    column.append(v)
            self.known.updateValue(place, (True,))
        self.newest.update(order[-1])
        yield self._frame(key, *out)

    def _frame(self, key, places, followers, kinds, rows):
        import pandas as pd

        cols = dict(zip(self.names, zip(*places)))
        return pd.DataFrame({**{c: list(v) for c, v in cols.items()}, "__lead_us": pd.array(followers, "Int64"), "__kind": kinds, "__row": rows, "__key": key[0]})

    def close(self) -> None:
        pass


class KeyedCdcTarget:
    """An SCD-2 table at ``base``. Everything it needs is an argument, so any job can open it, also before the first change."""

    def __init__(self, base: str, schema: T.StructType, keys: Sequence[str], sequence_by: Sequence[str], op_col: str = "operacion",
                 delete_ops: Sequence[str] = ("D",), truncate_ops: Sequence[str] = ("TRUNCATE",), except_columns: Sequence[str] = ()):
        if not isinstance(schema[sequence_by[0]].dataType, _TIMES):
            raise ValueError("the first sequence column must be a time")
        self.base, self.schema = base.rstrip("/"), schema
        self.keys, self.sequence_by = list(keys), list(sequence_by)
        self.op_col, self.delete_ops, self.truncate_ops = op_col, list(delete_ops), list(truncate_ops)
        self.except_columns = list(except_columns)
        kind = lambda t: T.LongType() if isinstance(t, (*_TIMES, T.IntegralType)) else T.StringType()
        self.place = T.StructType([T.StructField(f"__p{i}", kind(schema[c].dataType)) for i, c in enumerate(self.sequence_by)])
        self.out = T.StructType([*self.place, T.StructField("__lead_us", T.LongType()), T.StructField("__kind", T.StringType()), T.StructField("__row", T.StringType()),
                                 T.StructField("__key", T.StringType())])

    def places(self, changes: DataFrame) -> DataFrame:
        """Keys, place in the sequence, kind and packed row of every change."""
        op = F.col(self.op_col)
        kind = F.when(op.isin(*self.truncate_ops), "truncate").when(op.isin(*self.delete_ops), "delete").otherwise("version")
        own = [epoch_micros(c) if isinstance(self.schema[c].dataType, _TIMES) else F.col(c).cast(f.dataType) for c, f in zip(self.sequence_by, self.place)]
        key = F.when(kind == "truncate", F.lit(None)).otherwise(F.to_json(F.struct(*self.keys), {**_JSON, "ignoreNullFields": "false"}))
        return changes.select(key.alias("__key"), *[o.alias(f.name) for o, f in zip(own, self.place)], kind.alias("__kind"),
                              F.to_json(F.struct(*self.schema.names), _JSON).alias("__row"))

    def stream(self, changes: DataFrame) -> DataFrame:
        return self.places(changes).groupBy("__key").transformWithStateInPandas(
            statefulProcessor=Places(self.place), outputStructType=self.out, outputMode="Append", timeMode="None")

    def foreach_batch(self, batch: DataFrame, epoch_id: int) -> None:
        rows = batch.withColumns({EPOCH: F.lit(epoch_id), "_part": F.when(F.col("__kind") == "closed", "closed").otherwise("rows")})
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH, "_part").parquet(f"{self.base}/changes"))

    def start(self, changes: DataFrame, checkpoint: str, available_now: bool = True):
        """Start the stream; the keyed state lives under ``checkpoint``."""
        spark = changes.sparkSession
        before = spark.conf.get(PROVIDER)
        spark.conf.set(PROVIDER, ROCKSDB)      # a query keeps the settings it starts with
        try:
            w = self.stream(changes).writeStream.foreachBatch(self.foreach_batch).option("checkpointLocation", checkpoint)
            return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
        finally:
            spark.conf.set(PROVIDER, before)

    def changed(self, spark: SparkSession) -> DataFrame:
        """All rows written so far (an empty frame before the first)."""
        schema = T.StructType([*self.out, T.StructField(EPOCH, T.LongType()), T.StructField("_part", T.StringType())])
        path = f"{self.base}/changes"
        spark.createDataFrame([], schema).write.mode("append").partitionBy(EPOCH, "_part").parquet(path)   # the folder, if it isn't there
        return spark.read.schema(schema).parquet(path)

    def current(self, spark: SparkSession) -> DataFrame:
        """The history as of the last batch, truncates applied.

        A change's follower only ever moves nearer, so the least time written for
        its place is the valid one: one partial/final aggregate, no window.
        """
        held = self.changed(spark)
        row = F.from_json("__row", self.schema, _JSON)
        truncates = held.where("__kind = 'truncate'").select(row.alias("r")).select("r.*")
        versions = held.where("__kind = 'version'").select(row.alias("r"), *self.place.names, "__lead_us")
        closed = held.where("_part = 'closed'").groupBy("__key", *self.place.names).agg(F.min("__lead_us").alias("__closed_us"))
        key = F.to_json(F.struct(*[F.col(f"r.{c}") for c in self.keys]), {**_JSON, "ignoreNullFields": "false"}).alias("__key")
        joined = versions.withColumn("__key", key).join(closed, ["__key", *self.place.names], "left")
        lead = F.timestamp_add("MICROSECOND", F.least("__lead_us", "__closed_us"), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
        out = joined.select("r.*", lead.cast(self.schema[self.sequence_by[0]].dataType).alias("__lead"))
        payload = _payload(truncates, self.keys, self.sequence_by, self.except_columns)
        return close_versions(out, truncates, self.keys, self.sequence_by, payload)
