"""Queries over what the sinks have written: each writes below the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pubmill import sinks
from pubmill.plans.base import n, query, table
from pubmill.sources import collection as S
from pubmill.streaming import ledger as L


@query("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey <> 3")
def q_replaced_table(spark, d):
    """A table replaced three times; the last one is read."""
    root = sinks.scratch(spark, "table")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    for part in (c, c.where("c_nationkey = 3"), c.where("c_nationkey <> 3")):
        sinks.replace_table(part, root)
    return sinks.current_table(spark, root)


@query("SELECT event_type, count(*) AS n_events, sum(user_id)::BIGINT AS users, max(event_id) AS last FROM events GROUP BY 1")
def q_event_ledger(spark, d):
    """Events in four batches, two of which arrive again with other rows in between."""
    root = sinks.scratch(spark, "ledger")
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    for batch in (0, 1, 1, 2, 0, 3, 3):
        L.write_once(e.where(F.col("event_id") % 4 == batch), root, batch)
    return L.read_ledger(spark, root, e.schema).groupBy("event_type").agg(n().alias("n_events"), F.sum("user_id").alias("users"), F.max("event_id").alias("last"))


@query("""SELECT CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'DONE' END AS status, 'run-' || user_id % 5 AS run, count(*) * CASE WHEN user_id % 5 < 2 THEN 2 ELSE 1 END AS lines
  FROM events GROUP BY 1, 2, user_id % 5""")
def q_event_log(spark, d):
    """An event log of JSON lines; two runs are appended twice, as a log keeps what it is given."""
    path = sinks.scratch(spark, "log")
    run = F.concat(F.lit("run-"), (F.col("user_id") % 5).cast("string"))
    e = table(spark, d, "events").select(run.alias("run"), F.col("ts").cast("string").alias("at"), "event_type", F.when(F.col("event_type") == "error", "ERROR").otherwise("DONE").alias("status"))
    sinks.append_events(e, path)
    sinks.append_events(e.where("run in ('run-0', 'run-1')"), path)
    return spark.read.schema("run string, at string, event_type string, status string").json(path).groupBy("status", "run").agg(n().alias("lines"))


@query("""SELECT p_partkey::VARCHAR AS p_partkey, p_name, NULL AS missing, p_type || ' | ' || p_size AS tags, '{"brand":"' || p_brand || '"}' AS more, 'say "' || p_type || '"; ' || p_size AS quoted FROM part""")
def q_delimited(spark, d):
    """Files separated by ";", read back as they are."""
    path = sinks.scratch(spark, "csv")
    size = F.col("p_size").cast("string")
    rows = table(spark, d, "part").select("p_partkey", "p_name", F.array("p_type", size).alias("tags"), F.struct(F.col("p_brand").alias("brand")).alias("more"), F.concat(F.lit('say "'), "p_type", F.lit('"; '), size).alias("quoted"), F.lit(1).alias("left_out"))
    sinks.delimited(rows, ["p_partkey", "p_name", "missing", "tags", "more", "quoted"], path)
    return spark.read.option("sep", ";").option("header", "true").option("escape", '"').schema("p_partkey string, p_name string, missing string, tags string, more string, quoted string").csv(path)


@query("""SELECT 'PARTS BY TYPE' AS line UNION ALL SELECT rpad(p_type, 40, ' ') || ' ' || lpad(count(*)::VARCHAR, 12, ' ') FROM part GROUP BY p_type""")
def q_report_text(spark, d):
    """A text report, written and read back line by line."""
    path = sinks.scratch(spark, "report")
    counts = table(spark, d, "part").groupBy("p_type").agg(n().alias("k"))
    sinks.report_lines(counts, "PARTS BY TYPE", "p_type", "k").write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("""SELECT ts::DATE AS day, user_id % 3 AS purpose, count(*) AS records, count_if(event_type = 'error' AND user_id % 3 = 1) AS marked FROM events GROUP BY 1, 2""")
def q_snapshot(spark, d):
    """JSON by day and purpose; a second snapshot of one purpose replaces its partitions and no other."""
    path = sinks.scratch(spark, "json")
    e = table(spark, d, "events").select("event_id", "event_type", F.to_date("ts").alias("day"), (F.col("user_id") % 3).alias("purpose"), F.lit(False).alias("marked"))
    sinks.snapshot(e, path, "day", "purpose").count()
    again = e.where("purpose = 1").withColumn("marked", F.col("event_type") == "error")
    sinks.snapshot(again, path, "day", "purpose").count()
    back = spark.read.schema("event_id long, event_type string, marked boolean, day date, purpose long").json(path)
    return back.groupBy("day", "purpose").agg(n().alias("records"), F.count_if("marked").cast("bigint").alias("marked"))


@query("""SELECT 'JSON' AS kind, count(DISTINCT o_custkey % 40) AS files, count(*) AS records FROM orders UNION ALL SELECT 'OTHER', count(DISTINCT o_custkey % 3) + 1, 0 FROM orders""")
def q_inventory(spark, d):
    """Files of several kinds, counted with the records that they hold."""
    path = sinks.scratch(spark, "files")
    o = table(spark, d, "orders")
    key = (F.col("o_custkey") % 40).alias("part")
    o.groupBy(key).agg(F.collect_list(F.struct("o_orderkey")).alias("publications")).write.partitionBy("part").json(f"{path}/json")
    o.select((F.col("o_custkey") % 3).alias("part"), "o_orderkey").repartition("part").write.partitionBy("part").csv(f"{path}/csv")
    spark.range(1).select(F.lit("no list").alias("value")).write.text(f"{path}/text")
    files = S.inventory(spark, path, "part-*")
    return files.groupBy("kind").agg(n().alias("files"), F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records"))
