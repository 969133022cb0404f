"""Increment, ledger and file-stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators.joins import not_seen
from strataflow.plans.ingest import baseline_year, ingest_records, new_records
from strataflow.plans.ledger import FAILED, RUNNING, SKIPPED, SUCCESS, RunLedger, fold_checkpoints, fold_runs, last_run_per_scope
from strataflow.registry import query
from strataflow.registry.inputs import table
from strataflow.session import fresh_folder
from strataflow.sources.landed import read_envelopes
from strataflow.sinks.eventlog import STATES
from strataflow.sinks.tables import overwrite_partitions
from strataflow.streaming.increments import load_new_files, merge_partitions, write_touched


@query(
    "high_water_mark",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS date FROM orders
WHERE o_orderstatus <> 'P' AND year(o_orderdate) > 1997 AND year(o_orderdate) <= 2000""",
)
def high_water_mark(spark, sf):
    ledger = RunLedger(spark, fresh_folder(spark, "ledger"))
    ledger.save_checkpoint("orders", 1996)
    ledger.save_checkpoint("orders", 1997)
    date = F.when(F.col("o_orderstatus") == "P", F.lit("n.d.")).otherwise(F.year("o_orderdate").cast("string"))
    orders = table(spark, sf, "orders").select("o_orderkey", date.alias("date"))
    return new_records(orders, baseline_year(ledger.load_checkpoint("orders"), 1995), 2000)


def _as_runs(spark, sf):
    """Events as a run log: the user is the run, the event type its state."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "view", F.lit(RUNNING))
        .when(kind == "error", F.lit(FAILED))
        .when(kind == "signup", F.lit(SKIPPED))
        .otherwise(F.lit(SUCCESS))
    )
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("ingestion_run_id"),
        F.concat(F.lit("scope "), F.substring(F.col("user_id").cast("string"), -1, 1)).alias("run_scope"),
        F.col("ts").alias("event_ts"),
        status.alias("status"),
        F.when(kind != "error", F.col("event_id")).alias("rows_processed"),
        F.when(kind == "purchase", F.col("props")).alias("last_checkpoint"),
        F.when(kind == "error", F.col("props")).alias("error_message"),
    )


_RUNS_SQL = """runs AS (
  SELECT CAST(user_id AS VARCHAR) AS ingestion_run_id, 'scope ' || right(CAST(user_id AS VARCHAR), 1) AS run_scope,
    strftime(min(ts) FILTER (WHERE event_type = 'view'), '%Y-%m-%d %H:%M:%S') AS started,
    strftime(max(ts) FILTER (WHERE event_type <> 'view'), '%Y-%m-%d %H:%M:%S') AS ended,
    arg_max(CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED'
      ELSE 'SUCCESS' END, ts) AS status,
    arg_max(event_id, ts) FILTER (WHERE event_type <> 'error') AS rows_processed,
    arg_max(props, ts) FILTER (WHERE event_type = 'purchase') AS last_checkpoint,
    arg_max(props, ts) FILTER (WHERE event_type = 'error') AS error_message,
    min(ts) FILTER (WHERE event_type = 'view') AS start_ts
  FROM events GROUP BY user_id)"""
_RUN_COLUMNS = "ingestion_run_id, run_scope, started, ended, status, rows_processed, last_checkpoint, error_message"


def _printed(runs):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return runs.select(
        "ingestion_run_id",
        "run_scope",
        F.date_format("start_ts", stamp).alias("started"),
        F.date_format("end_ts", stamp).alias("ended"),
        "status",
        "rows_processed",
        "last_checkpoint",
        "error_message",
    )


@query("ledger_latest", f"WITH {_RUNS_SQL} SELECT {_RUN_COLUMNS} FROM runs")
def ledger_latest(spark, sf):
    return _printed(fold_runs(_as_runs(spark, sf)))


@query("ledger_compacted", f"WITH {_RUNS_SQL} SELECT {_RUN_COLUMNS} FROM runs")
def ledger_compacted(spark, sf):
    """The same log appended in seven parts, folded after every second and once more behind a compaction that was cut short."""
    ledger = RunLedger(spark, fresh_folder(spark, "ledger"))
    events = _as_runs(spark, sf)
    for part in range(7):
        ledger.run_log.append(events.where(F.col("rows_processed").isNull() if part == 6 else F.pmod("rows_processed", F.lit(6)) == part))
        if part % 2:
            ledger.compact()
    # A state without its list of files doesn't count.
    spark.range(1).write.parquet(f"{ledger.run_log.path}/{STATES}/{10**11:012d}-cut/rows")
    return _printed(ledger.list_runs())


@query(
    "ledger_last_run",
    f"""WITH {_RUNS_SQL} SELECT {_RUN_COLUMNS} FROM runs
QUALIFY row_number() OVER (PARTITION BY run_scope ORDER BY start_ts DESC NULLS LAST, ingestion_run_id DESC) = 1""",
)
def ledger_last_run(spark, sf):
    return _printed(last_run_per_scope(fold_runs(_as_runs(spark, sf))))


@query(
    "checkpoints",
    "SELECT CAST(user_id AS VARCHAR) AS source, arg_max(props, ts) AS value FROM events GROUP BY 1",
)
def checkpoints(spark, sf):
    saved = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("source"), F.col("props").alias("value"), F.col("ts").alias("saved_ts")
    )
    return fold_checkpoints(saved).select("source", "value")


@query(
    "revision_guard",
    """SELECT doc_id FROM documents d WHERE source <> 'src1'
AND NOT EXISTS (SELECT 1 FROM documents s WHERE s.source = 'src1' AND s.text = d.text)""",
)
def revision_guard(spark, sf):
    hashed = table(spark, sf, "documents").select("doc_id", "source", F.sha1("text").alias("record_hash"))
    seen, new = hashed.where(F.col("source") == "src1"), hashed.where(F.col("source") != "src1")
    return not_seen(new, seen, ["record_hash"]).select("doc_id")


_INGEST_SCOPE = "orders_api"


@query(
    "ledger_of_loads",
    f"""WITH r AS (SELECT o_orderstatus AS s, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT '{_INGEST_SCOPE}' AS run_scope, 'SUCCESS' AS status, count(*) AS rows_processed, CAST(max(y) AS VARCHAR) AS last_checkpoint
FROM r WHERE y <= 1998
UNION ALL SELECT '{_INGEST_SCOPE}', 'SUCCESS', count(*), CAST(max(y) AS VARCHAR) FROM r WHERE y > 1998
UNION ALL SELECT '{_INGEST_SCOPE}', 'SUCCESS', 0, CAST(max(y) AS VARCHAR) FROM r""",
)
def ledger_of_loads(spark, sf):
    """Three loads of landed pages: up to 1998, the rest, and nothing new."""
    landed, root = fresh_folder(spark, "landed"), fresh_folder(spark, "ingest")
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("countryiso3code"),
        F.year("o_orderdate").cast("string").alias("date"),
        F.col("o_totalprice").alias("value"),
    )
    body = F.concat(F.lit('[{"page":1},'), F.to_json(F.array(record)), F.lit("]"))
    table(spark, sf, "orders").select(body.alias("value")).write.text(landed)
    envelopes = read_envelopes(spark, landed, per_line=True)
    ledger = RunLedger(spark, f"{root}/metadata")
    for bound in (1998, None, None):
        ingest_records(
            envelopes, f"{root}/raw", ledger, max_year=bound, run_scope=_INGEST_SCOPE, checkpoint_key="orders"
        )
    return ledger.list_runs(_INGEST_SCOPE).select("run_scope", "status", "rows_processed", "last_checkpoint")


_EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]


def _stream_events(spark, sf, batches, columns=_EVENT_COLUMNS, partitions=("event_type",), again=False, **options):
    """Write JSON files in turn, running the file stream after each; ``again`` reads all files anew at the end."""
    from pyspark.sql.types import StructType

    root = fresh_folder(spark, "stream")

    def load(state):
        load_new_files(
            spark, f"{root}/in", schema, f"{root}/out", f"{root}/{state}", lambda df: df, partitions=list(partitions), **options
        )

    for batch in batches:
        schema = StructType(batch.schema.fields)
        batch.write.mode("append").json(f"{root}/in")
        load("state")
    if again:
        load("lost")
    return spark.read.schema(schema).parquet(f"{root}/out").select(columns)


@query("stream_new_files", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_new_files(spark, sf):
    events = table(spark, sf, "events").select(_EVENT_COLUMNS)
    early = F.col("event_type").isin("view", "click")
    return _stream_events(spark, sf, [events.where(early), events.where(~early)])


@query("stream_same_partition", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_same_partition(spark, sf):
    """Two runs with rows of the same partitions, and a third that has lost its state and reads all files again."""
    events = table(spark, sf, "events").select(_EVENT_COLUMNS)
    halves = [events.where(F.col("event_id") % 2 == i) for i in range(2)]
    return _stream_events(spark, sf, halves, again=True, max_files=2)


@query(
    "stream_merge_files",
    """SELECT event_id, user_id, event_type, CASE WHEN value < 10 THEN value + 1 ELSE value END AS value, props FROM events""",
)
def stream_merge_files(spark, sf):
    """A second set of files revises some events of partitions already stored."""
    events = table(spark, sf, "events").select(_EVENT_COLUMNS)
    revised = events.where(F.col("value") < 10).withColumn("value", F.col("value") + 1)
    return _stream_events(spark, sf, [events, revised], merge_on=["event_id"], latest_by=["value"])


@query("stream_split_partitions", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_split_partitions(spark, sf):
    """Files read one a batch, each of them with rows of every partition."""
    events = table(spark, sf, "events").select(_EVENT_COLUMNS)
    thirds = [events.where(F.col("event_id") % 3 == i) for i in range(3)]
    return _stream_events(spark, sf, thirds, merge_on=["event_id"], latest_by=["value"], max_files=1)


@query(
    "merge_null_partition",
    """SELECT event_id, event_type, CASE WHEN user_id % 2 = 0 THEN 'even' END AS side,
  CASE WHEN event_id % 10 = 0 THEN value + 1 ELSE value END AS value FROM events""",
)
def merge_null_partition(spark, sf):
    """A merge into partitions of which half have NULL as their second value."""
    path, parts = fresh_folder(spark, "merged"), ["event_type", "side"]
    side = F.when(F.col("user_id") % 2 == 0, F.lit("even")).alias("side")
    events = table(spark, sf, "events").select("event_id", "value", "event_type", side)
    overwrite_partitions(events, path, parts)
    revised = events.where(F.col("event_id") % 10 == 0).withColumn("value", F.col("value") + 1)
    rows, touched = merge_partitions(revised, path, ["event_id"], ["value"], parts)
    write_touched(rows, touched, path, parts)
    return spark.read.schema(events.schema).parquet(path).select("event_id", "event_type", "side", "value")


_PLACES = "a:b|a/b|50%|x=y z|ü#?"
_PLACE_SQL = f"string_split('{_PLACES}', '|')[CAST(user_id % 5 AS INTEGER) + 1]"


@query(
    "merge_escaped_partition",
    f"""SELECT event_id, value, CASE WHEN user_id % 5 < 3 OR event_id % 7 = 0 THEN '' || event_type ELSE {_PLACE_SQL} END AS place,
  CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, CASE WHEN user_id % 2 = 1 THEN 'odd' END AS side FROM events""",
)
def merge_escaped_partition(spark, sf):
    """Keys leave partitions whose values are escaped in a path (colons, slashes, percent signs), are dates, or empty, which is stored as NULL."""
    path, parts = fresh_folder(spark, "merged"), ["place", "month", "side"]
    place = F.get(F.split(F.lit(_PLACES), "[|]"), (F.col("user_id") % 5).cast("int"))
    events = table(spark, sf, "events").withColumns(
        {
            "place": place,
            "month": F.trunc("ts", "month"),
            "side": F.when(F.col("user_id") % 2 == 1, F.lit("odd")).otherwise(F.lit("")),
            "version": F.lit(1),
        }
    )
    columns = ["event_id", "value", "version", *parts]
    stored = events.select(columns)
    overwrite_partitions(stored, path, parts)
    leave = (F.col("user_id") % 5 < 3) | (F.col("event_id") % 7 == 0)
    moved = events.where(leave).withColumns({"place": F.col("event_type"), "version": F.lit(2)}).select(columns)
    rows, touched = merge_partitions(moved, path, ["event_id"], ["version"], parts)
    write_touched(rows, touched, path, parts)
    return spark.read.schema(stored.schema).parquet(path).select(
        "event_id", "value", "place", F.col("month").cast("string").alias("month"), "side"
    )
