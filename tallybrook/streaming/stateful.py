"""Order-dependent operators on Spark's keyed state (transformWithState).

Each operator keeps one small row per scope, window, id or customer in Spark's own state
store. A micro-batch brings the rows of a key together, sorted here by their arrival, so the
answer for a record depends on the records before it and not on how the stream is cut into
batches. Micro-batches must follow the order of arrival; their size is bounded by the reader
(files or offsets per trigger), and with it what one key holds in a task.

Windows, ids and customers are many and have few rows each: calling Python and the state store
for each of them costs far more than its rows. So they are dealt by hash into `buckets`, which
Spark groups by. The state of a bucket is one table with a row per key, and all its keys are
handled by column operations. A micro-batch writes the tables anew that it has rows for, so take
more buckets for more keys (some ten thousand each). Their number holds for the life of a
checkpoint and does not change the answer.

State goes by event time: it is removed when the stream has passed the time that it can
matter, plus `lag`. Records that are more than `lag` older than the newest record are late for
Spark itself and dropped.
"""

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..model import RETENTION_MS, WINDOW, WINDOW_KEY, WINDOW_MS
from ..operators.validate import DUPLICATE_ID, KEY_MISMATCH, MISSING_ID, violations, window_rules
from ..operators.windows import aggregate_windows, rekey

LAG = "7 days"
BUCKETS = 64


def _millis(times):
    """Epoch milliseconds of a column of timestamps without zone, which are UTC."""
    return times.astype("datetime64[ns]").astype("int64") // 1_000_000


def _plain(at):
    """A stored timestamp in the form of the rows."""
    at = pd.Timestamp(at)
    return at.tz_convert(None) if at.tzinfo else at


def _stored(at):
    return pd.Timestamp(at).to_pydatetime().replace(tzinfo=None)


def _whole(rows, order):
    """The rows of a key in this batch in order. Python None stands for missing values."""
    return pd.concat(list(rows)).sort_values(list(order), kind="stable", ignore_index=True)


def _fields(schema, *more):
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in more]])


def _timed(df, lag, time="timestamp"):
    """With a watermark, which needs a time with zone."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lag)


def _as_given(df, kind):
    """Times in the type of the input again."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast(kind) for c in zoned})


def _flat(records):
    """Records with one column per field of their structs `key` and `value`. (Names that begin
    with an underscore would not reach the processors.)"""
    columns = []
    for f in records.schema.fields:
        if isinstance(f.dataType, T.StructType):
            columns += [F.col(f"{f.name}.{x}").alias(f"{f.name}__{x}") for x in f.dataType.fieldNames()]
        else:
            columns.append(F.col(f.name))
    return records.select(*columns)


def _rebuilt(schema):
    """The columns of records that `_flat` took apart."""
    return [
        F.struct(*[F.col(f"{f.name}__{x}").alias(x) for x in f.dataType.fieldNames()]).alias(f.name)
        if isinstance(f.dataType, T.StructType)
        else F.col(f.name)
        for f in schema.fields
    ]


def _bucketed(df, keys, buckets):
    """With the bucket of the key columns."""
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _packed(frame):
    """A frame as one binary value, in Arrow's stream format."""
    table, sink = pa.Table.from_pandas(frame, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(value):
    return pa.ipc.open_stream(bytes(value[0])).read_pandas()


class _Buckets(StatefulProcessor):
    """Keeps one row per key, for all the keys of a bucket."""

    def init(self, handle):
        self.table = handle.getValueState("table", "rows binary")

    def _after_kept(self, frame, columns, keys):
        """Some columns of the kept rows and then of a frame, the number of the former, and the
        key of every row as a number."""
        both, n = frame[columns], 0
        if self.table.exists():
            kept = _unpacked(self.table.get())
            both, n = pd.concat([kept, both], ignore_index=True), len(kept)
        return both, n, both.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()

    def _keep(self, rows, until, timerValues):
        """Keeps the rows that can matter after the watermark; `until` are milliseconds."""
        self.table.update(_packed(rows[(until > timerValues.getCurrentWatermarkInMs()).to_numpy()]))

    def close(self):
        pass


class _Clock(StatefulProcessor):
    """Stream time of a scope: the highest timestamp seen, this record included."""

    def __init__(self, time, order, size, grace):
        self.time, self.order, self.size, self.grace = time, order, size, grace

    def init(self, handle):
        self.seen = handle.getValueState("stream_time", "at timestamp_ntz")

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)
        # a scope is large: only what its clock needs is brought together
        needed = list(dict.fromkeys((self.time, *self.order)))
        arrived = pd.concat([f[needed] for f in frames], ignore_index=True)
        clock = arrived.sort_values(list(self.order), kind="stable")[self.time].cummax()
        if self.seen.exists():
            clock = clock.clip(lower=_plain(self.seen.get()[0]))
        if clock.notna().any():
            self.seen.update((_stored(clock.max()),))
        clock, at = clock.sort_index(), 0
        for f in frames:
            upto = clock.iloc[at : at + len(f)].set_axis(f.index)
            end = f[self.time].dt.floor(self.size) + self.size
            yield f.assign(window_end=end, stream_time=upto, late=end + self.grace <= upto)
            at += len(f)

    def close(self):
        pass


def judge(records, size=WINDOW, grace="0 seconds", scope=("partition",), arrival=("offset",),
          time="timestamp", event_time=None, mode="Append"):
    """`judge_lateness` of a stream: adds `window_end`, `stream_time` and `late`.

    With `event_time` (a column of `records` that has a watermark) the result can feed a further
    stateful operator; `mode` is the output mode of the query. A scope keeps one timestamp for ever.
    """
    kind = records.schema[time].dataType
    out = _fields(records.schema, ("window_end", kind), ("stream_time", kind), ("late", T.BooleanType()))
    clock = _Clock(time, (*arrival, "offset"), pd.Timedelta(size), pd.Timedelta(grace))
    return records.groupBy(*scope).transformWithStateInPandas(
        clock, out, mode, "EventTime" if event_time else "None", eventTimeColumnName=event_time or ""
    )


def drop_late(records, **rule):
    """Records of a stream that are in time under the strict rule."""
    return judge(records, **rule).filter(~F.col("late")).select(*records.columns)


def in_retention(enriched, size=WINDOW, lag=LAG, scope=("partition",), arrival=("offset",), mode="Append"):
    """A stream without the records whose window ended a retention before the time of their
    partition. A rule per record: neither batches nor the removal of state change it. The result
    carries the watermark on."""
    timed = _timed(enriched, lag)
    grace = f"{RETENTION_MS} milliseconds"
    judged = judge(timed, size, grace, scope, arrival, event_time="timestamp", mode=mode)
    return judged.filter(~F.col("late")).select(*enriched.columns)


def totals(enriched, size=WINDOW, lag=LAG):
    """Windowed totals of a stream of enriched orders within their retention, in update mode:
    each micro-batch gives the new totals of the windows it changed. Sums are combined before
    the shuffle, so a window or customer may be of any size; the watermark removes windows."""
    windowed = aggregate_windows(in_retention(enriched.drop("order_id"), size, lag, mode="Update"), size)
    return _as_given(windowed, enriched.schema["timestamp"].dataType)


class _Running(_Buckets):
    """Running count and sum of each window, kept until its retention has passed."""

    def handleInputRows(self, key, rows, timerValues):
        f = _whole(rows, ("offset",))
        totals = ["order_count", "total_amount_cents"]
        both, n, window = self._after_kept(f, [*WINDOW_KEY, *totals], WINDOW_KEY)
        cents = both["total_amount_cents"].astype("Int64")
        known = cents.notna().groupby(window).cummax()
        both["order_count"] = both["order_count"].groupby(window).cumsum()
        both["total_amount_cents"] = cents.fillna(0).groupby(window).cumsum().where(known)
        kept = both[~pd.Series(window).duplicated(keep="last").to_numpy()]
        self._keep(kept, _millis(kept["window_end"]) + RETENTION_MS, timerValues)
        f[totals] = both[totals].iloc[n:].set_axis(f.index)
        yield f


def changelog(enriched, size=WINDOW, lag=LAG, buckets=BUCKETS):
    """`window_changelog` of a stream: one row per order with the totals of its window right
    after it. Records past the retention are dropped by the rule of `in_retention`."""
    kept = in_retention(enriched, size, lag)
    columns = [*WINDOW_KEY, "order_count", "total_amount_cents", "order_id", "partition", "offset", "timestamp"]
    rows = rekey(kept, size).select(*columns)
    dealt = _bucketed(rows, WINDOW_KEY, buckets).groupBy("bucket")
    steps = dealt.transformWithStateInPandas(_Running(), rows.schema, "Append", "EventTime")
    return _as_given(steps, enriched.schema["timestamp"].dataType)


class _Previous(_Buckets):
    """Totals of the record before, per key and window start."""

    def __init__(self, keys):
        self.keys = keys

    def handleInputRows(self, key, rows, timerValues):
        f = _whole(rows, ("offset",))
        pair = ["value__order_count", "value__total_amount_cents"]
        f[pair] = f[pair].astype("Int64")
        both, n, window = self._after_kept(f, [*self.keys, *pair], self.keys)
        f[["previous_count", "previous_cents"]] = both[pair].groupby(window).shift().iloc[n:].set_axis(f.index)
        kept = both[~pd.Series(window).duplicated(keep="last").to_numpy()]
        start = kept["start_key"]
        until = (_millis(start) + WINDOW_MS + RETENTION_MS).where(start.notna(), 2**62)
        self._keep(kept, until, timerValues)
        yield f


def validated_windows(records, unit_amount, width_ms=WINDOW_MS, lag=LAG, buckets=BUCKETS):
    """`validate_windows` of a stream of window records. What is known of a window is kept until
    its retention has passed."""
    present = records.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    rows = _timed(_flat(present).withColumn("start_key", F.col("value__window_start")), lag, "start_key")
    out = _fields(rows.schema, ("previous_count", T.LongType()), ("previous_cents", T.LongType()))
    keys = [*[f"key__{c}" for c in records.schema["key"].dataType.fieldNames()], "start_key"]
    dealt = _bucketed(rows, keys, buckets).groupBy("bucket")
    timed = dealt.transformWithStateInPandas(_Previous(keys), out, "Append", "EventTime")
    rules = window_rules(F.col("previous_count"), F.col("previous_cents"), unit_amount, width_ms)
    checked = timed.select(*_rebuilt(records.schema), "previous_count", "previous_cents")
    return checked.select(*records.columns, violations(*rules).alias("violations"))


class _SeenId(_Buckets):
    """The newest record time of each order id."""

    def __init__(self, id_column, remember):
        self.id_column, self.remember = id_column, remember

    def handleInputRows(self, key, rows, timerValues):
        f = _whole(rows, ("partition", "offset"))
        both, n, of_id = self._after_kept(f, [self.id_column, "timestamp"], [self.id_column])
        newest = both["timestamp"].groupby(of_id).cummax()
        before = newest.groupby(of_id).shift().iloc[n:].set_axis(f.index)
        f["repeated"] = before + self.remember > f["timestamp"]
        kept = both.dropna().groupby(self.id_column, sort=False)["timestamp"].max().reset_index()
        self._keep(kept, _millis(kept["timestamp"] + self.remember), timerValues)
        yield f


def marked_repeats(records, id_column, remember="1 day", lag=LAG, buckets=BUCKETS):
    """Adds `repeated` to a stream: whether an earlier record of the same id has a time later
    than this one's less `remember`. A rule per record; an id is forgotten when the stream has
    passed its newest time by `remember` and `lag`."""
    kind = records.schema["timestamp"].dataType
    timed = _timed(records, lag)
    out = _fields(timed.schema, ("repeated", T.BooleanType()))
    seen = _SeenId(id_column, pd.Timedelta(remember))
    dealt = _bucketed(timed, [id_column], buckets).groupBy("bucket")
    marked = dealt.transformWithStateInPandas(seen, out, "Append", "EventTime")
    return _as_given(marked, kind)


def validated_orders(records, remember="1 day", lag=LAG, buckets=BUCKETS):
    """`validate_orders` of a stream of order records, repeats judged by `marked_repeats`.
    Records without an id are judged by themselves: each is its own key."""
    present = records.filter(F.col("value").isNotNull())
    named = F.nullif(F.col("value__order_id"), F.lit(""))
    alone = F.concat_ws(":", F.lit("\u0000"), "partition", "offset")
    rows = _flat(present).withColumns({"id_key": F.coalesce(named, alone), "id_missing": named.isNull()})
    judged = marked_repeats(rows, "id_key", remember, lag, buckets)
    judged = judged.select(*_rebuilt(records.schema), "id_missing", "repeated")
    return judged.select(
        *records.columns,
        violations(
            (MISSING_ID, F.col("id_missing")),
            (KEY_MISMATCH, ~F.col("value.customer_id").eqNullSafe(F.col("key"))),
            (DUPLICATE_ID, F.col("repeated") & ~F.col("id_missing")),
        ).alias("violations"),
    )


def _enriched(orders):
    """Orders with a tier, one at a time, in the columns of `_ENRICHED`."""
    tier = orders["tier"].astype(object)
    out = orders.rename(columns={"amount_cents": "total_amount_cents"})
    return out.assign(tier=tier.where(tier.notna(), None), order_count=1)[_ENRICHED.fieldNames()]


class _Newest(_Buckets):
    """The newest profile version of each customer."""

    def handleInputRows(self, key, rows, timerValues):
        f = pd.concat(list(rows), ignore_index=True)
        is_order = f["is_order"].astype(bool)
        orders, versions = f[is_order], f[~is_order & f["key"].notna()]
        newest = versions[["key", "offset", "tier"]].sort_values("offset", kind="stable", ascending=False)
        if self.table.exists():
            newest = pd.concat([newest.drop_duplicates("key"), _unpacked(self.table.get())])
            newest = newest.sort_values("offset", kind="stable", ascending=False)
        newest = newest.drop_duplicates("key")
        if len(versions):
            self.table.update(_packed(newest))
        if len(orders):
            yield _enriched(orders.assign(tier=orders["key"].map(newest.set_index("key")["tier"])))


def enrich_current(orders, history, buckets=BUCKETS):
    """`enrich_current` of two streams: each order with the newest profile that has arrived by
    its micro-batch, whatever their times. (`enrich_asof` goes by time and waits.)

    A customer's newest version is kept in the state, so a micro-batch reads the profiles of
    its own customers only and no history is read again. Newest is the highest offset; a
    deletion is a version without a tier, and an order without a profile has a null tier. What
    comes out can feed `totals` and the other operators.
    """
    both = _one_stream(orders, history, lambda df, time: df.withColumn("timestamp", time.cast("timestamp_ntz")))
    dealt = _bucketed(both, ["key"], buckets).groupBy("bucket")
    return dealt.transformWithStateInPandas(_Newest(), _ENRICHED, "Append", "None")


class _Versions(StatefulProcessor):
    """Profile versions of the customers of a bucket, and the orders that wait for the stream to pass them."""

    def init(self, handle):
        self.handle = handle
        self.versions = handle.getValueState("versions", "rows binary")
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        f = pd.concat(list(rows), ignore_index=True)
        f = f[f["key"].notna()]  # heartbeats have none
        is_order = f["is_order"].astype(bool)
        orders, versions = f[is_order], f[~is_order & f["timestamp"].notna()]
        if len(versions):
            known = versions[["key", "timestamp", "offset", "tier"]]
            if self.versions.exists():
                known = pd.concat([_unpacked(self.versions.get()), known])
            self.versions.update(_packed(known.sort_values(["timestamp", "offset"], kind="stable")))
        timeless = orders["timestamp"].isna()
        if timeless.any():
            yield _enriched(orders[timeless].assign(tier=None))
        orders = orders[~timeless].drop(columns=["is_order", "tier"])
        if len(orders):
            orders["amount_cents"] = orders["amount_cents"].astype("Int64")
            self.waiting.appendList([_packed(orders)])
            due, held = int(_millis(orders["timestamp"]).min()), list(self.handle.listTimers())
            # one timer, at the earliest order that waits
            if not held or due < min(held):
                for old in held:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        orders = pd.concat([_unpacked(v) for v in self.waiting.get()], ignore_index=True)
        is_ready = _millis(orders["timestamp"]) <= passed
        ready, rest = orders[is_ready], orders[~is_ready]
        self.waiting.clear()
        if len(rest):
            self.waiting.put([_packed(rest)])
            # the timer that expires is still listed
            self.handle.registerTimer(int(_millis(rest["timestamp"]).min()))
        if not self.versions.exists():
            yield _enriched(ready.assign(tier=None))
            return
        known = _unpacked(self.versions.get())
        # of the versions that the stream has passed only the newest can still be asked for
        old = _millis(known["timestamp"]) <= passed
        replaced = known[old].duplicated("key", keep="last")
        if replaced.any():
            self.versions.update(_packed(known.drop(index=replaced[replaced].index)))
        ready = ready.sort_values("timestamp", kind="stable")
        known = known[["key", "timestamp", "tier"]]
        yield _enriched(pd.merge_asof(ready, known, on="timestamp", by="key"))

    def close(self):
        pass


_ENRICHED = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("tier", T.StringType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("total_amount_cents", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)


def _one_stream(orders, history, timed):
    """Orders and profile versions in rows of one form; `timed` sets the time of either."""
    order = orders.select(
        "key", F.lit(True).alias("is_order"), "timestamp", "partition", "offset", "order_id", "currency",
        "amount_cents", F.lit(None).cast("string").alias("tier"),
    )
    tier = F.when(~F.coalesce(F.col("deleted"), F.lit(False)), F.col("tier"))
    version = history.select(
        "key", F.lit(False).alias("is_order"), "timestamp", "partition", "offset",
        F.lit(None).cast("string").alias("order_id"), F.lit(None).cast("string").alias("currency"),
        F.lit(None).cast("bigint").alias("amount_cents"), tier.alias("tier"),
    )
    time = F.col("timestamp")
    return timed(order, time).unionByName(timed(version, time))


def enrich_asof(orders, history, lag="1 hour", buckets=BUCKETS):
    """`enrich_asof` of two streams: each order with the profile version valid at its record
    time, whichever of the two arrives first, as long as neither is more than `lag` behind.

    An order waits until both streams have passed its time, then it is joined and given out once.
    A deletion is a version without a tier. Versions that no later order can ask for are dropped.
    The last orders come out when later records of both streams, or heartbeats (rows of a
    null key, which give nothing out), move the time on. After a restart time stands still
    until both streams have brought a record.
    """
    def timed(df, time):
        return df.withColumn("timestamp", time.cast("timestamp")).withWatermark("timestamp", lag)

    # each stream has its own watermark, and the slower one counts
    both = _one_stream(orders, history, timed)
    dealt = _bucketed(both, ["key"], buckets).groupBy("bucket")
    return dealt.transformWithStateInPandas(_Versions(), _ENRICHED, "Append", "EventTime")
