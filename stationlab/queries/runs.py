"""Experiment log: every user's event history is logged as one run."""

from pyspark.sql import functions as F

from ..functions.columns import attach_row
from ..functions.scale import scratch_path
from ..operators import runs as L
from .registry import R, query, r8, rounded, table

LOG_SQL = """runs AS MATERIALIZED (SELECT 'run_' || user_id AS run_id, max(event_type) AS experiment FROM events GROUP BY 1),
params AS MATERIALIZED (SELECT 'run_' || user_id AS run_id, 'info_events' AS key, CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY 1
  UNION ALL SELECT 'run_' || user_id, 'first_day', CAST(CAST(min(ts) AS DATE) AS VARCHAR) FROM events GROUP BY 1),
last AS MATERIALIZED (SELECT 'run_' || user_id AS run_id, event_type AS key, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2)"""


def logged(spark, d):
    """Append the log in two batches and read it back."""
    root = scratch_path(spark, "runs")
    e = table(spark, d, "events").withColumn("run_id", F.concat(F.lit("run_"), F.col("user_id").cast("string")))
    ts = F.to_timestamp_ltz(F.col("ts"))
    runs = e.groupBy("run_id").agg(F.max("event_type").alias("experiment"), F.min(ts).alias("started"), F.lit("FINISHED").alias("status"))
    counts = e.groupBy("run_id").agg(F.count("*").cast("string").alias("n"), F.min("ts").cast("date").cast("string").alias("first"))
    params = counts.selectExpr("run_id", "inline(array(named_struct('key', 'info_events', 'value', n), named_struct('key', 'first_day', 'value', first)))")
    metrics = e.select("run_id", F.col("event_type").alias("key"), "value", F.col("event_id").alias("step"), ts.alias("ts"))
    mid = F.to_timestamp_ltz(F.lit("2024-01-15"))
    L.append_runs(root, runs.filter(F.col("started") < mid), params.limit(0), metrics.filter(F.col("ts") < mid))
    L.append_runs(root, runs.filter(F.col("started") >= mid), params, metrics.filter(F.col("ts") >= mid))
    return [L.log_table(spark, root, n) for n in ("runs", "params", "metrics")]


@query(
    "log_experiment",
    f"""WITH {LOG_SQL} SELECT 'runs' AS name, count(*) AS rows, count(DISTINCT run_id) AS ids, CAST(NULL AS DOUBLE) AS total FROM runs
    UNION ALL SELECT 'params', count(*), count(DISTINCT run_id), NULL FROM params
    UNION ALL SELECT 'metrics', count(*), count(DISTINCT user_id), {R('sum(CAST(round(value * 100) AS BIGINT)) / 1e2')} FROM events""",
)
def log_experiment(spark, d):
    runs, params, metrics = logged(spark, d)

    def size(df, name, total):
        return df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.count_distinct("run_id").alias("ids"), total.alias("total"))

    none = F.lit(None).cast("double")
    total = F.sum(F.round(F.col("value") * 100).cast("long")) / F.lit(100.0)
    out = size(runs, "runs", none).unionByName(size(params, "params", none)).unionByName(size(metrics, "metrics", total))
    return rounded(out, "total")


@query(
    "run_details",
    f"""WITH {LOG_SQL} SELECT runs.run_id, experiment, last.key AS metric, last.value AS value, e.value AS events, f.value AS first_day
    FROM runs JOIN last ON runs.run_id = last.run_id JOIN params e ON e.run_id = runs.run_id AND e.key = 'info_events'
    JOIN params f ON f.run_id = runs.run_id AND f.key = 'first_day'""",
)
def run_details(spark, d):
    out = L.run_details(*logged(spark, d))
    return out.select("run_id", "experiment", F.col("params")["info_events"].alias("events"), F.col("params")["first_day"].alias("first_day"), F.explode("metrics").alias("metric", "value"))


@query(
    "experiment_summary",
    f"""WITH {LOG_SQL} SELECT experiment, count(*) AS runs FROM runs GROUP BY 1""",
)
def experiment_summary(spark, d):
    return L.experiment_summary(*logged(spark, d))


@query(
    "experiment_runs",
    f"""WITH {LOG_SQL}, b AS (SELECT max(experiment) AS e FROM runs), k AS (SELECT DISTINCT event_type AS key FROM events)
    SELECT runs.run_id, k.key AS metric, any_value(p.value) AS param_info_events, max(CASE WHEN last.key = k.key THEN last.value END) AS value
    FROM runs JOIN b ON runs.experiment = b.e JOIN last ON last.run_id = runs.run_id JOIN params p ON p.run_id = runs.run_id AND p.key = 'info_events', k
    GROUP BY 1, 2""",
)
def experiment_runs(spark, d):
    runs, params, metrics = logged(spark, d)
    name = runs.agg(F.max("experiment")).first()[0]
    out = L.experiment_summary(runs, params, metrics, name, as_maps=True)
    kinds = L.log_keys(metrics).select(F.col("key").alias("metric"))
    # every run with every key of the log, as a flat form would have it
    every = attach_row(out, kinds.agg(F.collect_set("metric").alias("kinds")), "_all")
    cells = every.select("run_id", F.col("params")["info_events"].alias("param_info_events"), F.explode("_all.kinds").alias("metric"), "metrics")
    return cells.select("run_id", "param_info_events", "metric", F.try_element_at("metrics", F.col("metric")).alias("value"))


@query(
    "log_one_by_one",
    f"""SELECT event_type AS experiment, CAST(count(*) AS VARCHAR) AS rows, CAST(min(event_id) AS VARCHAR) AS first_event, {R('sum(CAST(round(value * 100) AS BIGINT)) / 1e2')} AS total,
    CAST(count(DISTINCT user_id) AS DOUBLE) AS users FROM events GROUP BY 1""",
)
def log_one_by_one(spark, d):
    """One logged run for each kind of event, with a text metric that is not kept."""
    root = scratch_path(spark, "runs")
    total = F.sum(F.round(F.col("value") * 100).cast("long")) / F.lit(100.0)
    kinds = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), total.alias("total"), F.count_distinct("user_id").alias("users"))
    for k in kinds.collect():
        L.log_experiment(spark, root, k.event_type, {"first_event": k["first"]}, {"rows": k.n}, {"total": k.total, "users": k.users, "note": "text"})
    out = L.run_details(*[L.log_table(spark, root, n) for n in ("runs", "params", "metrics")]).filter(F.size("metrics") == 2)
    p, m = F.col("params"), F.col("metrics")
    return rounded(out.select("experiment", p["rows"].alias("rows"), p["info_first_event"].alias("first_event"), m["total"].alias("total"), m["users"].alias("users")), "total")
