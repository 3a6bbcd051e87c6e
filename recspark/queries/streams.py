"""Event-time streams over ``events`` and the log, fed wave by wave as rows would arrive.

Rows arrive in the order of their time, but for some that come a wave later and some that come two waves later, after the
watermark has passed them.  Every wave is appended to the stream's folder and drained, so each query restarts from its
checkpoint several times.  The SQL finds the watermark of each wave and with it the rows and windows that count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import scratch_path, stored
from ..sources import views as V
from ..streaming.incremental import file_stream
from ..streaming.windows import drain_to, session_steps, sessions, windowed_rates, without_repeats
from .registry import query

WAVES = 5


def arrivals(rows: DataFrame, number: str, waves: int = WAVES, late: bool = True) -> DataFrame:
    """Adds ``wave``, when a row arrives: by time, a tenth one wave later, some of each wave's first half two waves later."""
    us = F.unix_micros("ts")
    ends = rows.agg(F.min(us).alias("__low"), (F.max(us) - F.min(us) + 1).alias("__span"))
    timed = rows.crossJoin(F.broadcast(ends))  # a single row
    half = F.expr(f"((unix_micros(ts) - __low) * {2 * waves}) div __span")
    lag = F.when(F.expr(f"{number} % 10 = 3"), 1)
    if late:
        lag = lag.when(F.expr(f"{number} % 31 = 7") & (half % 2 == 0), 2)
    return (timed.withColumn("wave", F.least(F.floor(half / 2) + F.coalesce(lag, F.lit(0)), F.lit(waves - 1)).cast("int"))
            .drop("__low", "__span"))


def arrivals_sql(rows: str, number: str, delay: str, waves: int = WAVES, late: bool = True) -> str:
    """CTEs ``arrived`` (rows with ``us``, ``wave`` and ``mark``, the watermark they meet) and ``final`` (the last watermark)."""
    two = f" WHEN {number} % 31 = 7 AND half % 2 = 0 THEN 2" if late else ""
    return (f"timed AS (SELECT *, epoch_us(ts) AS us FROM {rows}), placed AS (SELECT *, ((us - (SELECT min(us) FROM timed)) * {2 * waves})"
            " // (SELECT max(us) - min(us) + 1 FROM timed) AS half FROM timed),"
            f" waved AS (SELECT *, least(half // 2 + CASE WHEN {number} % 10 = 3 THEN 1{two} ELSE 0 END, {waves - 1}) AS wave FROM placed),"
            f" tops AS (SELECT wave, max(us) // 1000 * 1000 - {delay} AS top FROM waved GROUP BY wave),"
            " arrived AS (SELECT waved.*, coalesce((SELECT max(top) FROM tops WHERE tops.wave < waved.wave), 0) AS mark FROM waved),"
            " final AS (SELECT max(top) AS done FROM tops)")


def through_stream(rows: DataFrame, make, waves: int = WAVES) -> tuple[DataFrame, list[dict]]:
    """What ``make`` turns a stream of the arriving rows into, and the progress of all its batches."""
    spark, folder = rows.sparkSession, scratch_path(rows.sparkSession, "stream")
    rows, progress = stored(rows, "arrivals"), []
    plain = rows.drop("wave")
    for wave in range(waves):
        rows.where(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{folder}/in")
        progress += drain_to(make(file_stream(spark, f"{folder}/in", plain.schema)), f"{folder}/out", f"{folder}/progress")
    return spark.read.parquet(f"{folder}/out"), progress


def _events(spark, path):
    return V.table(spark, path, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
                                                 F.col("value").cast("decimal(18,2)").alias("value"))


def _log(spark, path):
    # an order's line arrives by its own number
    return V.log(spark, path).select(F.col("ts").cast("timestamp").alias("ts"), (F.col("order_id") * 10 + F.col("line")).alias("number"),
                                     "relevance", F.col("amount").cast("decimal(18,4)").alias("amount"))


def _seconds(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.unix_seconds(c) for c in columns})


DAY_US, HOUR_US = 86_400_000_000, 3_600_000_000
EVENTS = "SELECT event_id, ts, user_id, event_type, cast(value as decimal(18,2)) AS value FROM events"
LOG = V.with_views("SELECT ts, order_id * 10 + line AS number, relevance, cast(amount as decimal(18,4)) AS amount FROM log", "log")


def _rates_sql(rows: str, number: str, hit: str, amount: str, delay: int, length: int, slide: int, keys: str = "") -> str:
    """Windows of ``length`` every ``slide`` microseconds: rows whose window the watermark had not passed, windows it has."""
    return (f"WITH {arrivals_sql(f'({rows})', number, str(delay))}, cut AS (SELECT *, us // {slide} * {slide} - i * {slide} AS start FROM arrived,"
            f" range(0, {length // slide}) AS r(i)), kept AS (SELECT * FROM cut WHERE start + {length} > mark)"
            f" SELECT start // 1000000 AS window_start, (start + {length}) // 1000000 AS window_end{keys}, count(*) AS n,"
            f" cast(count(CASE WHEN {hit} THEN 1 END) as bigint) AS hits, count(CASE WHEN {hit} THEN 1 END) / count(*) AS rate,"
            f" cast(coalesce(sum(CASE WHEN {hit} THEN {amount} END), 0) as double) AS revenue"
            f" FROM kept, final WHERE start + {length} <= done GROUP BY start{keys}")


def _rates(rows, make):
    found, _ = through_stream(rows, make)
    return _seconds(found, "window_start", "window_end").withColumn("revenue", F.col("revenue").cast("double"))


@query("ext2_tumbling_rates", _rates_sql(EVENTS, "event_id", "event_type = 'purchase'", "value", 7 * DAY_US, DAY_US, DAY_US))
def tumbling_rates(spark, path):
    """Daily share of purchases among events and their value."""
    return _rates(arrivals(_events(spark, path), "event_id"), lambda s: windowed_rates(
        s, F.col("event_type") == "purchase", F.col("value"), "1 day", delay="7 days"))


@query("ext2_sliding_rates_by_type", _rates_sql(EVENTS, "event_id", "value > 50", "value", 7 * DAY_US, 24 * HOUR_US, 6 * HOUR_US, ", event_type"))
def sliding_rates(spark, path):
    """For each event type, every six hours: the share of values above 50 in a day, and their sum."""
    return _rates(arrivals(_events(spark, path), "event_id"), lambda s: windowed_rates(
        s, F.col("value") > 50, F.col("value"), "24 hours", "6 hours", "7 days", ["event_type"]))


@query("ext2_log_tumbling_rates", _rates_sql(LOG, "number", "relevance = 1", "amount", 700 * DAY_US, 30 * DAY_US, 30 * DAY_US))
def log_tumbling_rates(spark, path):
    """Share of kept purchases of the log and their revenue in windows of 30 days."""
    return _rates(arrivals(_log(spark, path), "number"), lambda s: windowed_rates(
        s, F.col("relevance") == 1, F.col("amount"), "30 days", delay="700 days"))


@query("ext2_log_sliding_rates", _rates_sql(LOG, "number", "relevance = 1", "amount", 700 * DAY_US, 90 * DAY_US, 30 * DAY_US))
def log_sliding_rates(spark, path):
    return _rates(arrivals(_log(spark, path), "number"), lambda s: windowed_rates(
        s, F.col("relevance") == 1, F.col("amount"), "90 days", "30 days", "700 days"))


GAP_US = 6 * HOUR_US
# gaps and islands among the rows that came before the watermark had passed their own window
ISLANDS = (f"kept AS (SELECT * FROM arrived WHERE us + {GAP_US} > mark), steps AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id"
           f" ORDER BY us, event_id) < {GAP_US} THEN 0 ELSE 1 END AS fresh FROM kept), numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id"
           " ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS island FROM steps), island AS (SELECT user_id, island, min(us) AS start,"
           f" max(us) + {GAP_US} AS stop, count(*) AS n, arg_min(event_type, (us, event_id)) AS first_state, arg_max(event_type, (us, event_id))"
           " AS last_state FROM numbered GROUP BY user_id, island)")


def _sessions(stream):
    return sessions(stream, "user_id", "6 hours", "event_type", "event_id", "7 days")


@query("ext3_sessions", f"WITH {arrivals_sql(f'({EVENTS})', 'event_id', str(7 * DAY_US))}, {ISLANDS} SELECT user_id, start // 1000000 AS session_start,"
       " stop // 1000000 AS session_end, n, first_state, last_state FROM island, final WHERE stop <= done")
def user_sessions(spark, path):
    """Finished sessions of every user, six hours apart, from rows that came late, in time and too late."""
    found, _ = through_stream(arrivals(_events(spark, path), "event_id"), _sessions)
    return _seconds(found, "session_start", "session_end")


@query("ext3_session_sequences", f"WITH {arrivals_sql(f'({EVENTS})', 'event_id', str(7 * DAY_US), late=False)}, {ISLANDS} SELECT user_id,"
       " start // 1000000 AS session_start, row_number() OVER (PARTITION BY user_id, island ORDER BY us, event_id) AS step, event_type AS state"
       " FROM numbered JOIN island USING (user_id, island), final WHERE stop <= done")
def session_sequences(spark, path):
    """The order of event types within the finished sessions of a stream."""
    events = _events(spark, path)
    found, _ = through_stream(arrivals(events, "event_id", late=False), _sessions)
    return _seconds(session_steps(events, found, "user_id", "event_type", "event_id"), "session_start")


@query("ext4_late_and_repeated", f"WITH {arrivals_sql(f'({EVENTS})', 'event_id', str(7 * DAY_US))} SELECT event_id, user_id, event_type,"
       " cast(value as double) AS value FROM arrived WHERE us > mark")
def late_and_repeated(spark, path):
    """Each user's events once, though a third is sent twice, and without those that come after the watermark."""
    rows = arrivals(_events(spark, path), "event_id")
    again = rows.where("event_id % 3 = 0").withColumn("wave", F.least(F.col("wave") + (F.col("event_id") % 2).cast("int"), F.lit(WAVES - 1)))
    found, _ = through_stream(rows.unionByName(again), lambda s: without_repeats(s, ["user_id", "event_id"], "7 days"))
    return found.select("event_id", "user_id", "event_type", F.col("value").cast("double").alias("value"))
