"""The running application: which queries exist, what they read and where they write.

Each topic is parsed by its bronze query; a second small query stores the records that cannot be
parsed. Metric queries read the bronze folder
of their topic as a stream (or the topic itself, by setting). Each metric has its own query, as
each needs its own state and watermark.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry import schemas
from basketry.config import Settings
from basketry.functions.dates import between_days, seconds_of
from basketry.functions.parse import dead_letters, of_type, parse_events
from basketry.operators.ranking import first_per_key
from basketry.plans import cdc, kpi
from basketry.session import streaming_session
from basketry.sources.files import ensure_folder, read_small_files, stream_dataset, write_small_file
from basketry.sources.kafka import read_cdc, read_topics
from basketry.streaming.bronze import append_stream
from basketry.streaming.joins import dedup_stream
from basketry.streaming.runs import open_run
from basketry.streaming.upsert_log import upsert_stream, write_batch

Transform = Callable[[DataFrame, Settings], DataFrame]


@dataclass(frozen=True)
class Metric:
    """A keyed metric table: its topic, its event type, its transform and its key."""

    topic: str
    event_type: str | None
    transform: Transform
    keys: tuple[str, ...]
    mode: str = "update"
    #: SQL for what names an event; a repeat counts once while the watermark remembers the first.
    id: str | None = None


_MIXED_ID = "concat(event_type, '/', if(event_type = 'order_returned', return_id, order_id))"


METRICS = {
    "revenue_per_minute": Metric(
        "orders", "order_placed", kpi.revenue_per_minute, ("window_start",), id="order_id"
    ),
    "geographic_metrics": Metric(
        "orders", "order_placed", kpi.geographic_metrics, ("window_start", "country"), id="order_id"
    ),
    "product_metrics": Metric(
        "orders", "order_placed", kpi.product_metrics, ("window_start", "product_id"), id="order_id"
    ),
    "net_revenue": Metric("orders", None, kpi.net_revenue, ("window_start",), id=_MIXED_ID),
    "returns_by_reason": Metric(
        "orders", "order_returned", kpi.returns_by_reason, ("window_start", "reason"), id="return_id"
    ),
    "failed_payments": Metric("payments", None, kpi.failed_payments, ("window_start",), id="payment_id"),
    "active_users": Metric("users", None, kpi.active_users_approx, ("window_start",)),
    "user_sketches": Metric("users", None, kpi.user_sketches, ("window_start",)),
    "active_users_exact": Metric("users", None, kpi.active_users_exact, ("window_start",), "append"),
    "click_windows": Metric(
        "clicks", None, lambda df, s: kpi.click_windows(df, settings=s), ("window_start",)
    ),
    "page_windows": Metric("clicks", None, kpi.page_windows, ("window_start", "page_url")),
    "inventory_changes": Metric(
        "inventory", None, kpi.inventory_changes, ("window_start", "product_id", "warehouse_id")
    ),
}


def metric_frame(name: str, events: DataFrame, settings: Settings) -> DataFrame:
    """A metric over the parsed events of its topic.

    A stream leaves out repeated events; the rows of a table all count. An event without an id
    is no repeat of another one, unless all its columns are equal.
    """
    metric = METRICS[name]
    if metric.event_type:
        events = of_type(events, metric.event_type)
    if events.isStreaming and metric.id and settings.dedup_metrics:
        named = events.withColumn("_event_id", F.expr(metric.id))
        events = dedup_stream(named, ["_event_id"], settings).drop("_event_id")
    elif events.isStreaming:
        events = events.withWatermark("event_time", settings.watermark)
    return metric.transform(events, settings)


def start_metric(
    name: str, events: DataFrame, settings: Settings, table: str, checkpoint: str, trigger: str | None = None,
    also: Callable[[DataFrame, int], None] | None = None, since: dt.datetime | None = None,
) -> StreamingQuery:
    """Start one metric; `also` gets each batch too, as a publisher to a database would.

    With `since`, the cut of `seed_metric`, only windows from then on are sent. Events of one
    watermark before it are still read, as repeats of them may follow.
    """
    if since is not None:
        before = F.lit(since) - F.expr(f"INTERVAL {settings.watermark}") - F.expr(f"INTERVAL {settings.window}")
        day = (since - dt.timedelta(seconds=seconds_of(settings.watermark) + seconds_of(settings.window))).date()
        events = events.filter(F.col("event_time") >= before)
        if {"year", "month", "day"} <= set(events.columns):
            events = events.filter(between_days(day, dt.date(9998, 12, 31)))  # leaves whole folders out
    frame, metric = metric_frame(name, events, settings), METRICS[name]
    if since is not None:
        frame = frame.filter(F.col("window_start") >= F.lit(since))
    return upsert_stream(
        frame, table, checkpoint, trigger, metric.mode, name, also, metric.keys, settings.fold_every,
        settings.fold_grace_seconds,
    )


def cut_of(spark: SparkSession, events: DataFrame, settings: Settings) -> dt.datetime | None:
    """The newest window start whose earlier windows are closed: the watermark of a stream that has
    seen these events."""
    newest = events.agg((F.max("event_time") - F.expr(f"INTERVAL {settings.watermark}")).alias("closed"))
    start = F.window("closed", settings.window)["start"]
    row = newest.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("cut")).first()
    return dt.datetime.fromisoformat(row.cut) if row else None


def seed_metric(
    spark: SparkSession, name: str, events: DataFrame, settings: Settings, table: str, cut: dt.datetime | None = None
) -> dt.datetime | None:
    """Fill a metric table from stored events up to a cut, which is recorded with the table, and
    return the cut. `start_metric` with `since` goes on from there.

    All windows before the cut are closed, so their batch values are final. An event counts once,
    as on the stream. Seeding again changes nothing.
    """
    metric = METRICS[name]
    place = f"{table.rstrip('/')}/_seed/cut.json"
    known = read_small_files(spark, f"{table.rstrip('/')}/_seed")
    if known:
        return dt.datetime.fromisoformat(json.loads(known["cut.json"])["cut"])
    cut = cut or cut_of(spark, events, settings)
    if cut is None:
        return None
    if metric.event_type:
        events = of_type(events, metric.event_type)
    if metric.id and settings.dedup_metrics:
        # The first to arrive counts on the stream; of a table, the earliest.
        named = events.withColumn("_event_id", F.expr(metric.id))
        # Without an id an event is told apart by all its columns, as on the stream.
        named = named.withColumn("_own", F.when(F.col("_event_id").isNull(), F.to_json(F.struct("*"))))
        events = first_per_key(named, ["_event_id", "_own"], [F.col("event_time").asc_nulls_last()]).drop("_event_id", "_own")
    closed = metric.transform(events, settings).filter(F.col("window_start") < F.lit(cut))
    run = open_run(spark, table, f"seed {cut}")
    write_batch(closed, 0, table, run)
    write_small_file(spark, place, json.dumps({"cut": str(cut), "run": run.number}))
    return cut


def start_all(
    spark: SparkSession, settings: Settings, starting_offsets: str,
    records_of: Callable[[SparkSession, Sequence[str]], DataFrame] | None = None,
    publish: Callable[[str, DataFrame, int], None] | None = None,
) -> list[StreamingQuery]:
    """Start bronze, metric and change-feed queries; the caller waits with await_any.

    Records come from the broker, or from `records_of`, which gets a session and topic names.
    `publish` gets each batch of each metric table with its name, to write it elsewhere. With the
    trigger set to "" the queries take all that is there and end.
    """
    session = streaming_session(spark, settings)
    trigger = settings.trigger or None
    queries = []
    parsed = {}
    for topic, schema in schemas.TOPIC_SCHEMAS.items():
        names = [settings.topics[topic]]
        records = records_of(session, names) if records_of else read_topics(session, settings, names, starting_offsets)
        parsed[topic] = parse_events(records, schema, settings.max_ahead_minutes)
        queries.append(start_dead_letters(topic, records, settings, trigger))
        queries.append(
            append_stream(
                parsed[topic], settings.bronze(topic), settings.checkpoint(f"bronze_{topic}"),
                trigger=trigger, name=f"bronze_{topic}",
            )
        )
    for name, metric in METRICS.items():
        if settings.kpi_source == "bronze":
            folder = settings.bronze(metric.topic)
            ensure_folder(session, folder)
            events = stream_dataset(
                session, folder, schemas.bronze(metric.topic), settings.max_files_per_trigger
            )
        else:
            events = parsed[metric.topic]
        queries.append(
            start_metric(
                name, events, settings, settings.metric(name), settings.checkpoint(f"metric_{name}"), trigger,
                partial(publish, name) if publish else None,
            )
        )
    changes = records_of(session, settings.cdc_topics()) if records_of else read_cdc(session, settings)
    queries.append(start_cdc(session, settings, changes, trigger))
    return queries


def start_dead_letters(
    topic: str, records: DataFrame, settings: Settings, trigger: str | None = None
) -> StreamingQuery:
    """Store the records of a topic that bronze leaves out, with the reason."""
    bad = dead_letters(records, schemas.TOPIC_SCHEMAS[topic], settings.max_ahead_minutes)
    return append_stream(
        bad, settings.dead_letters(topic), settings.checkpoint(f"dead_letters_{topic}"), ("reason",),
        trigger, f"dead_letters_{topic}",
    )


def start_cdc(
    spark: SparkSession, settings: Settings, records: DataFrame, trigger: str | None = None
) -> StreamingQuery:
    return append_stream(
        cdc.silver(records), settings.silver("cdc"), settings.checkpoint("silver_cdc"),
        ("table_name", "year", "month", "day"), trigger, "silver_cdc",
    )


def await_any(spark: SparkSession) -> None:
    """Wait until a query ends; a failure is raised here and ends the application."""
    spark.streams.awaitAnyTermination()
