"""Pairing of start and end events into trips, a live dashboard, and change feeds on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.geo import distance_miles
from tidemark.functions.semantics import half_even
from tidemark.sources.changes import apply_changes, last_change
from tidemark.streaming.streams import for_each_batch, write_stream


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHARES = 4096


def _order(values: tuple) -> tuple:
    """Sort key of a row as Spark orders structs: nulls first, NaN last."""
    return tuple((0, 0) if x is None else (2, 0) if x != x else (1, x) for x in values)


def _same(x: object) -> object:
    """What a key is found by: equal for values that Spark groups together, and fit for a dict."""
    if isinstance(x, list | tuple):
        return tuple(map(_same, x))
    return bytes(x) if isinstance(x, bytearray) else "NaN" if x != x else x


class _Pairing(StatefulProcessor):
    """State of one share of the keys: a list of its keys, each with its first start and last end so far. A batch that changes a
    key gives the pair as it is now.

    Calls to the state cost far more than the rows, so a share is read and written as a whole, once a batch. A key that stays idle
    is forgotten by the timer of its share, which is set to the first key that is due, so the state holds open keys only. An event
    that comes later begins anew; its row corrects the sink, as pairs of one key merge by the least start and the greatest end.
    """

    def __init__(self, keys: list[str], status: str, start: str, fields: list[str], state: str, idle_ms: int):
        self.keys, self.status, self.start, self.fields, self.state, self.idle_ms = keys, status, start, fields, state, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("pair", self.state)
        self.latest = handle.getValueState("latest", "seen long")  # of all keys of the share
        self.row = Row(*self.keys, *[f"start_{f}" for f in self.fields], *[f"end_{f}" for f in self.fields], "has_start", "has_end")

    def handleInputRows(self, key, rows, timerValues):
        k, n = len(self.keys), len(self.fields)
        known = {_same(x[:k]): x for x in self.held.get()}
        sides, values = {}, {}
        for row in rows:
            mine = tuple(row[c] for c in self.keys)
            at = _same(mine)
            if at not in sides:
                x = known.get(at)
                sides[at] = [x[k:k + n] if x and x[-3] else None, x[k + n:k + 2 * n] if x and x[-2] else None]
                values[at] = mine
            pair, seen = sides[at], tuple(row[f] for f in self.fields)
            if row[self.status] == self.start:
                pair[0] = seen if pair[0] is None else min(pair[0], seen, key=_order)
            else:
                pair[1] = seen if pair[1] is None else max(pair[1], seen, key=_order)
        now = timerValues.getCurrentWatermarkInMs()
        if not known:
            self.handle.registerTimer(now + self.idle_ms)
        nothing, changed = (None,) * n, []
        for at, (first, last) in sides.items():
            pair = (*values[at], *(first or nothing), *(last or nothing), first is not None, last is not None)
            if at not in known or known[at][k:-1] != pair[k:]:
                changed.append(pair)
            known[at] = (*pair, now)
        self.held.put(list(known.values()))
        self.latest.update((now,))
        yield from (self.row(*pair) for pair in changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due, latest = expiredTimerInfo.getExpiryTimeInMs() - self.idle_ms, self.latest.get()
        known = list(self.held.get()) if latest and latest[0] > due else []
        still = [x for x in known if x[-1] > due]
        if not still:
            self.held.clear()
            self.latest.clear()
        else:
            if len(still) < len(known):
                self.held.put(still)
            self.handle.registerTimer(min(x[-1] for x in still) + self.idle_ms)
        return iter(())

    def close(self) -> None:
        pass


def pair_stream(
    stream: DataFrame, keys: list[str], ts: str, status: str, start: str, end: str, carry: list[str],
    path: str, checkpoint: str, idle: str = "1 DAY", shares: int = SHARES,
) -> DataFrame:
    """Trips of a stream of start and end events: state of open keys, and a sink of the pairs that changed.

    The state is kept in ``shares`` of the keys, dealt by hash, which a checkpoint fixes; a batch reads and writes the shares that it
    has rows of, so more keys open at a time ask for more shares.

    The clock of the timers is the time of arrival, not that of the events, so no event is too late: one that comes after its
    key was forgotten (``idle`` without any event) still corrects the trip. The sink is written exactly once, and a restart
    goes on from the checkpoint with the same state. Events without a time pair with nothing.
    """
    fields = [ts, *carry]
    types = {f.name: f.dataType.simpleString() for f in stream.schema}
    sides = [f"`{side}_{f}` {types[f]}" for side in ("start", "end") for f in fields] + ["has_start boolean", "has_end boolean"]
    held = [*[f"`{k}` {types[k]}" for k in keys], *sides]
    spark = stream.sparkSession
    idle_ms = int(spark.range(1).select(F.expr(f"unix_millis(timestamp'1970-01-01 00:00:00' + INTERVAL {idle}) - unix_millis(timestamp'1970-01-01 00:00:00')")).first()[0])
    rows = (
        stream.filter(F.col(status).isin(start, end) & F.col(ts).isNotNull()).select(*keys, status, *[f for f in fields if f not in keys])
        .withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", "0 seconds")
        .withColumn("__share", F.pmod(F.xxhash64(*keys), F.lit(shares)).cast("int"))
    )
    processor = _Pairing(keys, status, start, fields, ", ".join([*held, "seen long"]), idle_ms)
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)  # keyed state with timers lives there only
    try:
        write_stream(rows.groupBy("__share").transformWithState(processor, ", ".join(held), "append", "eventTime"), path, checkpoint)
    finally:
        spark.conf.set(_STATE_STORE, before) if before else spark.conf.unset(_STATE_STORE)
    return read_pairs(spark, path, keys, ts, carry)


def read_pairs(spark: SparkSession, path: str, keys: list[str], ts: str, carry: list[str]) -> DataFrame:
    """The trips of the sink of ``pair_stream``, each from the rows in which its key changed; an end before its start makes no trip."""
    fields = [ts, *carry]

    def side(name: str) -> Column:
        return F.when(F.col(f"has_{name}"), F.struct(*[F.col(f"{name}_{f}").alias(f) for f in fields]))

    merged = spark.read.parquet(path).groupBy(*keys).agg(F.min(side("start")).alias("__a"), F.max(side("end")).alias("__b"))
    return merged.filter(F.col("__b")[ts] >= F.col("__a")[ts]).select(
        *keys,
        *[F.col("__a")[c].alias(f"start_{c}") for c in fields],
        *[F.col("__b")[c].alias(f"end_{c}") for c in fields],
    )


def trip_columns(pairs: DataFrame, ts: str, lat: str, lon: str, amount: str) -> DataFrame:
    """Distance in miles, whole minutes and amount of each pair."""
    miles = distance_miles(F.col(f"start_{lat}"), F.col(f"start_{lon}"), F.col(f"end_{lat}"), F.col(f"end_{lon}"))
    return pairs.withColumns({
        "distance": half_even(miles, 5),
        "minutes": F.timestamp_diff("MINUTE", f"start_{ts}", f"end_{ts}"),
        "amount": half_even(F.col(f"end_{amount}"), 2),
    })


def dashboard(trips: DataFrame, zones: DataFrame, zone_key: str, zone_name: str, interval: str, as_of: Column) -> DataFrame:
    """One row of live figures: ride count, averages, and the busiest start and end zone with their counts.

    One pass: each trip counts for itself, for its start zone and for its end zone; equal counts go to the smaller zone.
    """
    since = as_of - F.expr(f"INTERVAL {interval}")
    rides, pickup, dropoff = 0, 1, 2

    def entry(side: int, zone: Column, ts: str) -> Column:
        return F.when(F.col(ts).between(since, as_of), F.struct(F.lit(side).alias("side"), zone.alias("zone")))

    kind = trips.schema["start_zone"].dataType
    seen = F.explode(F.array(entry(rides, F.lit(None).cast(kind), "start_ts"), entry(pickup, F.col("start_zone"), "start_ts"), entry(dropoff, F.col("end_zone"), "end_ts")))
    measures = ["minutes", "amount", "distance"]
    sums = trips.select(seen.alias("at"), *measures).filter("at IS NOT NULL").groupBy("at.side", "at.zone").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in measures], *[F.count(c).alias(f"n_{c}") for c in measures])

    def mean(c: str) -> Column:
        share = F.try_divide(F.sum(F.when(F.col("side") == rides, F.col(c))).cast("double"), F.sum(F.when(F.col("side") == rides, F.col(f"n_{c}"))))
        return half_even(F.coalesce(share, F.lit(0)), 2).alias(f"average_{c}")

    def top(side: int) -> Column:
        busy = (F.col("side") == side) & F.col("zone").isNotNull()
        return F.min(F.when(busy, F.struct((-F.col("n")).alias("less"), "zone")))

    figures = sums.agg(
        F.coalesce(F.sum(F.when(F.col("side") == rides, F.col("n"))), F.lit(0)).alias("ride_count"), *[mean(c) for c in measures],
        top(pickup).alias("__pickup"), top(dropoff).alias("__dropoff"))
    for side in ("pickup", "dropoff"):
        names = zones.select(F.col(zone_key).alias("__zone"), F.col(zone_name).alias(f"{side}_zone"))
        figures = figures.join(names, F.col(f"__{side}.zone") == F.col("__zone"), "left").drop("__zone").withColumn(f"{side}_rides", -F.col(f"__{side}.less"))
    return figures.drop("__pickup", "__dropoff")


def apply_changes_stream(stream: DataFrame, base: DataFrame, keys: list[str], op: str, order: list[str], path: str, checkpoint: str) -> DataFrame:
    """Latest state of a table under a streamed change log.

    Each micro-batch keeps only its last change per key. The state is the base under the last of
    those; a batch that runs again rewrites the same folder.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        last_change(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    for_each_batch(stream, save, checkpoint)
    log = stream.sparkSession.read.parquet(path).drop("batch")
    return apply_changes(base, log, keys, op, order)
