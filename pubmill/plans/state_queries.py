"""Queries of incremental state: orders and events play processes, attempts, runs and sends."""

from __future__ import annotations

from pyspark.sql import functions as F

from pubmill.operators import state as S
from pubmill.plans.base import n, query, table
from pubmill.sinks import archive_audit


def _orders(spark, d):
    return table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))


@query("SELECT o_custkey AS key, arg_min(o_orderpriority, o_orderkey) AS payload, count(*) AS seen FROM orders GROUP BY 1")
def q_baseline(spark, d):
    return S.baseline(table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("payload")))


@query("""WITH s AS (SELECT o_custkey AS key, max(o_orderdate)::DATE AS last
  FROM orders GROUP BY 1), r AS (SELECT o_custkey AS key, max(o_orderdate::DATE + 30 - (o_orderkey % 60)::INT) AS until FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT s.key, CASE WHEN r.key IS NOT NULL THEN 'ACTIVE' ELSE 'PENDING' END AS status, greatest(last, until) AS last FROM s LEFT JOIN r USING (key)""")
def q_history_promotion(spark, d):
    o = _orders(spark, d)
    state = o.groupBy(F.col("o_custkey").alias("key")).agg(F.lit("PENDING").alias("status"), F.max("day").alias("last"))
    reviewed = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"), F.date_add("day", (30 - F.col("o_orderkey") % 60).cast("int")).alias("last"))
    return S.promote(state, reviewed)


# Orders of a customer as attempts: status, count, origin, reference, error and expected documents follow from the key.
_ATTEMPTS = """a AS (SELECT o_custkey AS key, o_orderkey AS ord, CASE o_orderkey % 5 WHEN 0 THEN 'SEARCHED_WITH' WHEN 1 THEN 'SEARCHED_WITHOUT' WHEN 2 THEN 'NOTHING_NEW'
  WHEN 3 THEN 'PARTIAL' ELSE 'FAILED' END AS status,
 CASE o_orderkey % 5 WHEN 0 THEN o_orderkey % 3 WHEN 1 THEN 0 END AS found, CASE WHEN o_orderkey % 11 = 0 THEN 'NONE' ELSE 'SITE' END AS origin, CASE
  WHEN o_orderkey % 13 <> 0 THEN 'ref' END AS reference,
 CASE WHEN o_orderkey % 5 = 4 AND o_orderkey % 2 = 0 THEN 'timeout' END AS error, (o_orderkey * 7) % 10 AS expected FROM orders),
v AS (SELECT *, coalesce(CASE WHEN status IN ('SEARCHED_WITH', 'SEARCHED_WITHOUT', 'NOTHING_NEW') THEN reference IS NOT NULL AND origin <> 'NONE' AND CASE status
  WHEN 'NOTHING_NEW' THEN coalesce(found, 0) = 0 WHEN 'SEARCHED_WITH' THEN found > 0 ELSE found = 0 END
 ELSE status <> 'FAILED' OR error IS NOT NULL END, false) AS valid FROM a)"""


def attempts(spark, d):
    k, kind = F.col("o_orderkey"), F.col("o_orderkey") % 5
    status = F.element_at(F.lit([*S.CONCLUDED, "PARTIAL", "FAILED"]), (kind + 1).cast("int"))
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("key"),
        k.alias("ord"),
        status.alias("status"),
        F.when(kind == 0, k % 3).when(kind == 1, F.lit(0)).alias("found"),
        F.when(k % 11 == 0, "NONE").otherwise("SITE").alias("origin"),
        F.when(k % 13 != 0, "ref").alias("reference"),
        F.when((kind == 4) & (k % 2 == 0), "timeout").alias("error"),
        (k * 7 % 10).alias("expected"),
    )


@query(f"WITH {_ATTEMPTS} SELECT ord, valid FROM v")
def q_evidence(spark, d):
    a = attempts(spark, d)
    return a.select("ord", S.evidence_valid(F.col("status"), F.col("found"), F.col("origin"), F.col("reference"), F.col("error")).alias("valid"))


@query(f"""WITH RECURSIVE {_ATTEMPTS}, e AS (SELECT *, row_number() OVER (PARTITION BY key
  ORDER BY ord) AS i, concat_ws('|', status, coalesce(found::VARCHAR, '-'), origin, coalesce(reference, '-'), coalesce(error, '-'), expected) AS print FROM v),
f AS (SELECT key, 0::BIGINT AS i, NULL::VARCHAR AS status, NULL::BIGINT AS found, NULL::BIGINT AS expected, NULL::VARCHAR AS print, 0::BIGINT AS attempts,
  0::BIGINT AS rejected FROM (SELECT DISTINCT key FROM e)
 UNION ALL SELECT f.key, e.i, x.status, x.found, x.expected, x.print, x.attempts, x.rejected FROM f JOIN e ON e.key = f.key AND e.i = f.i + 1, LATERAL (SELECT
  CASE WHEN NOT e.valid THEN 'no' WHEN e.print = f.print THEN 'same'
  WHEN coalesce(f.status IN ('SEARCHED_WITH', 'SEARCHED_WITHOUT', 'NOTHING_NEW'), false) AND e.expected <= coalesce(f.expected, 0) THEN 'no' ELSE 'yes' END AS what) w,
  LATERAL (SELECT CASE w.what WHEN 'yes' THEN e.status ELSE f.status END AS status, CASE w.what WHEN 'yes' THEN e.found ELSE f.found END AS found, CASE w.what
  WHEN 'yes' THEN e.expected ELSE f.expected END AS expected,
   CASE w.what WHEN 'yes' THEN e.print ELSE f.print END AS print, f.attempts + (w.what = 'yes')::BIGINT AS attempts, f.rejected + (w.what = 'no')::BIGINT AS rejected) x)
SELECT key, status, found, expected, attempts, rejected FROM f WHERE i = (SELECT max(e.i) FROM e WHERE e.key = f.key)""")
def q_evidence_upsert(spark, d):
    return S.upsert(attempts(spark, d))


@query("""WITH r AS (SELECT DISTINCT 'http://x/' || p_partkey AS url
  FROM part WHERE p_partkey % 3 <> 0), k AS (SELECT sha256('http://x/' || p_partkey) AS key, CASE WHEN p_partkey % 4 = 0 THEN 'PROCESSED' ELSE 'BASELINE' END AS status
  FROM part WHERE p_partkey % 2 = 0)
SELECT sha256(url) AS key, url, coalesce(status, 'NEW_PENDING') AS status FROM r LEFT JOIN k ON k.key = sha256(url)""")
def q_discovery(spark, d):
    return _discovered(spark, d)


def _discovered(spark, d):
    url = F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string"))
    part = table(spark, d, "part")
    known = part.where("p_partkey % 2 = 0").select(F.sha2(url, 256).alias("key"), F.when(F.col("p_partkey") % 4 == 0, "PROCESSED").otherwise("BASELINE").alias("status"))
    return S.discover(known, part.where("p_partkey % 3 <> 0").select(url.alias("url")))


@query("SELECT sha256('http://x/' || p_partkey) AS key, 'http://x/' || p_partkey AS url FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 2 <> 0 AND p_partkey % 5 <> 0")
def q_pending_documents(spark, d):
    done = table(spark, d, "part").where("p_partkey % 5 = 0").select(F.sha2(F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string")), 256).alias("key"))
    return S.pending_documents(_discovered(spark, d), done)


@query("""WITH u AS (SELECT c_custkey AS process, s AS source
  FROM customer, (VALUES ('GAZETTE'), ('MINUTES'), ('AGENDA')) t(s)
  WHERE c_custkey % 4 <> 0), c AS (SELECT o_custkey AS process, ['GAZETTE', 'MINUTES', 'AGENDA'][(o_orderkey % 3 + 1)::INT] AS source,
  count(*) FILTER (o_orderstatus = 'F') AS found FROM orders GROUP BY 1, 2)
SELECT coalesce(u.process, c.process) AS process, coalesce(u.source, c.source) AS source, CASE WHEN u.process IS NULL THEN 'FOREIGN'
  WHEN u.process % 10 = 1 THEN 'PENDING' WHEN coalesce(found, 0) > 0 THEN 'SEARCHED_WITH' ELSE 'SEARCHED_WITHOUT' END AS status FROM u
  FULL JOIN c ON u.process = c.process AND u.source = c.source""")
def q_reconcile(spark, d):
    sources = F.lit(["GAZETTE", "MINUTES", "AGENDA"])
    universe = table(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").cast("long").alias("process"), F.explode(sources).alias("source"))
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("long").alias("process"), F.element_at(sources, (F.col("o_orderkey") % 3 + 1).cast("int")).alias("source")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("found"))
    return S.reconcile(universe, counts, F.col("process") % 10 != 1)


@query("""WITH f AS (SELECT user_id AS run, event_type AS stage, min(event_id) AS done
  FROM events WHERE value > 20 GROUP BY 1, 2) SELECT run, string_agg(stage, '>' ORDER BY done) AS stages FROM f GROUP BY 1""")
def q_checkpoints(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_type").alias("stage"), F.col("event_id").alias("at"), F.when(F.col("value") > 20, "DONE").otherwise("PARTIAL").alias("status"))
    return S.checkpoints(e).select("run", F.array_join("stages", ">").alias("stages"))


@query("""WITH w AS (SELECT o_custkey AS signature, o_orderdate::DATE AS day, count(*) AS rows
  FROM orders GROUP BY 1, 2), m AS (SELECT o_custkey AS signature, o_orderdate::DATE AS day, arg_max(o_orderkey % 2 + 1, o_orderkey) AS rows
  FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2)
SELECT w.signature, w.day, w.rows, coalesce(w.rows = m.rows, false) AS reuse FROM w LEFT JOIN m USING (signature, day)""")
def q_reuse(spark, d):
    o, on = _orders(spark, d).withColumnRenamed("o_custkey", "signature"), ["signature", "day"]
    made = o.where("o_orderkey % 3 <> 0").select(*on, (F.col("o_orderkey") % 2 + 1).alias("rows"), F.col("o_orderkey").alias("at"))
    return S.reusable(o.groupBy(*on).agg(n().alias("rows")), made, on)


@query("""WITH a AS (SELECT o_custkey AS process
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) = 1 AND bool_and(o_orderkey % 5 <> 0)), p AS (SELECT o_custkey AS process
  FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING count(*) = 1 AND bool_and(o_orderkey % 7 <> 0)),
x AS (SELECT o_custkey AS process FROM orders WHERE o_orderpriority LIKE '5%' AND o_orderkey % 4 = 0) SELECT c_custkey AS process, c_custkey IN (SELECT process
  FROM a) AND c_custkey IN (SELECT process FROM p) AND c_custkey NOT IN (SELECT process FROM x) AS proven FROM customer""")
def q_contingency_proof(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "process")
    audits = o.where("o_orderstatus = 'F'").select("process", (F.col("o_orderkey") % 5 != 0).alias("day_ok"))
    pagination = o.where("o_orderstatus = 'O'").select("process", F.lit(True).alias("complete"), (F.col("o_orderkey") % 7 != 0).alias("day_ok"))
    return S.contingency_proof(table(spark, d, "customer").select(F.col("c_custkey").alias("process")), audits, pagination, o.where("o_orderpriority like '5%' and o_orderkey % 4 = 0"))


@query("""WITH l AS (SELECT user_id AS run, event_type AS stage, arg_max(CASE WHEN event_id % 9 = 0 THEN 'ERROR'
  WHEN event_id % 7 = 0 THEN 'STARTED' ELSE 'DONE' END, event_id) AS status, max((value * 3)::INT) AS progress FROM events GROUP BY 1, 2)
SELECT run, least(greatest(max(progress), 0), 100)::BIGINT AS progress, CASE WHEN count_if(status = 'ERROR') > 0 THEN 'ERROR'
  WHEN count_if(status <> 'DONE') > 0 THEN 'PARTIAL' ELSE 'DONE' END AS status FROM l GROUP BY 1""")
def q_run_status(spark, d):
    k = F.col("event_id")
    status = F.when(k % 9 == 0, "ERROR").when(k % 7 == 0, "STARTED").otherwise("DONE")
    e = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_type").alias("stage"), k.alias("at"), status.alias("status"), F.round(F.col("value") * 3).cast("int").alias("progress"))
    return S.run_status(e)


@query("""WITH d AS (SELECT o_orderdate::DATE AS day, sha256(min(o_orderkey)::VARCHAR) AS version, count(*) > 1 AS complete, max(o_orderkey) % 7 = 0 AS pending,
  min(o_orderkey) AS k FROM orders GROUP BY 1),
s AS (SELECT o_orderdate::DATE AS day, sha256(o_orderkey::VARCHAR) AS version, CASE o_orderkey % 5 WHEN 0 THEN 'UNDETERMINED'
  WHEN 1 THEN 'FAILED' ELSE 'SENT' END AS state FROM orders WHERE o_orderkey % 3 = 0)
SELECT d.day, d.version, CASE WHEN EXISTS (SELECT 1
  FROM s WHERE s.day = d.day AND state = 'UNDETERMINED') THEN 'BLOCKED' WHEN NOT complete OR pending THEN 'NOT_READY' WHEN EXISTS (SELECT 1
  FROM s WHERE s.day = d.day AND s.version = d.version AND state = 'SENT') THEN 'SENT' ELSE 'SEND' END AS verdict FROM d""")
def q_send_gate(spark, d):
    o = _orders(spark, d)
    days = o.groupBy("day").agg(F.min("o_orderkey").cast("string").alias("content"), (F.count("*") > 1).alias("complete"), (F.max("o_orderkey") % 7 == 0).alias("pending"))
    k = F.col("o_orderkey")
    sends = o.where("o_orderkey % 3 = 0").select("day", F.sha2(k.cast("string"), 256).alias("version"), F.when(k % 5 == 0, "UNDETERMINED").when(k % 5 == 1, "FAILED").otherwise("SENT").alias("state"))
    return S.send_gate(days, sends)


@query("""WITH g AS (SELECT o_custkey AS key, list_distinct(list(substr(o_orderpriority, 1, 1))) AS done FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey AS key, coalesce(list_contains(done, '1')
  AND list_contains(done, '2'), false) AS minutes, coalesce(list_contains(done, '3'), false) AS gazette, coalesce(list_contains(done, '1') AND list_contains(done, '2')
  AND list_contains(done, '3'), false) AS "full"
FROM customer LEFT JOIN g ON g.key = c_custkey""")
def q_required_coverage(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"), F.substring("o_orderpriority", 1, 1).alias("source"))
    return S.required_coverage(done, table(spark, d, "customer").select(F.col("c_custkey").alias("key")), {"minutes": ["1", "2"], "gazette": ["3"]})


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'FORCED' WHEN o_orderstatus = 'O' THEN 'RUN'
  WHEN NOT coalesce(o_totalprice > 100000 AND o_orderkey % 6 <> 0, false) THEN 'RERUN' ELSE 'SKIP' END AS plan FROM orders""")
def q_should_run(spark, d):
    valid = F.when(F.col("o_orderkey") % 6 != 0, F.col("o_totalprice") > 100000)
    return table(spark, d, "orders").select("o_orderkey", S.should_run(F.col("o_orderstatus") != "O", valid, F.col("o_orderkey") % 11 == 0).alias("plan"))


@query("""WITH c AS (SELECT o_custkey AS key, o_orderkey % 4 <> 0 AS required, CASE o_orderkey % 9 WHEN 0 THEN 'INVALID' WHEN 1 THEN 'INCOMPLETE'
  WHEN 2 THEN 'PENDING' ELSE 'OK' END AS state FROM orders),
g AS (SELECT key, count_if(required) AS need, count_if(required AND state = 'OK') AS n_ok, max(list_position(['OK', 'PENDING', 'INCOMPLETE', 'INVALID'], state)) AS place
  FROM c GROUP BY 1)
SELECT key, n_ok, round(CASE WHEN need > 0 THEN 100.0::DOUBLE * n_ok / need ELSE 0 END, 2) AS share, CASE WHEN n_ok = need THEN 'COMPLETE'
  WHEN n_ok > 0 THEN 'PARTIAL' ELSE 'PENDING' END AS status, ['OK', 'PENDING', 'INCOMPLETE', 'INVALID'][place] AS worst FROM g""")
def q_completeness(spark, d):
    kind = F.col("o_orderkey") % 9
    state = F.when(kind == 0, "INVALID").when(kind == 1, "INCOMPLETE").when(kind == 2, "PENDING").otherwise("OK")
    return S.completeness(table(spark, d, "orders").select(F.col("o_custkey").alias("key"), (F.col("o_orderkey") % 4 != 0).alias("required"), state.alias("state")), "key")


@query(f"""WITH {_ATTEMPTS} SELECT o_orderdate::DATE AS day, CASE WHEN bool_and(status IN ('SEARCHED_WITH', 'SEARCHED_WITHOUT', 'NOTHING_NEW') AND valid) THEN 'COMPLETE'
  WHEN bool_or(status IN ('SEARCHED_WITH', 'SEARCHED_WITHOUT', 'NOTHING_NEW') AND valid) THEN 'PARTIAL' ELSE 'NONE' END AS modality
FROM v JOIN orders ON o_orderkey = ord GROUP BY 1""")
def q_delivery(spark, d):
    grid = attempts(spark, d).join(_orders(spark, d).select(F.col("o_orderkey").alias("ord"), "day"), "ord")
    return S.delivery(grid, S.evidence_valid(F.col("status"), F.col("found"), F.col("origin"), F.col("reference"), F.col("error")))


@query("SELECT o_orderstatus AS status, count(*) AS processes, max(o_orderdate)::DATE AS last, count(DISTINCT o_custkey) AS owners FROM orders GROUP BY 1")
def q_state_summary(spark, d):
    return _orders(spark, d).groupBy(F.col("o_orderstatus").alias("status")).agg(n().alias("processes"), F.max("day").alias("last"), F.countDistinct("o_custkey").alias("owners"))


@query("SELECT event_type AS stage, count(*) AS errors, min(ts)::DATE AS first_day, count(DISTINCT user_id) AS runs FROM events WHERE value > 40 GROUP BY 1")
def q_error_summary(spark, d):
    e = table(spark, d, "events").where("value > 40")
    return e.groupBy(F.col("event_type").alias("stage")).agg(n().alias("errors"), F.to_date(F.min("ts")).alias("first_day"), F.countDistinct("user_id").alias("runs"))


@query("""WITH f AS (SELECT sha256(o_orderkey::VARCHAR) AS own, CASE WHEN o_orderkey % 6 = 0 THEN 'bad' || o_orderkey ELSE sha256(o_orderkey::VARCHAR) END AS digest
  FROM orders WHERE o_orderkey % 4 <> 0), l AS (SELECT sha256(o_orderkey::VARCHAR) AS digest FROM orders WHERE o_orderkey % 5 <> 0)
SELECT coalesce(f.digest, l.digest) AS digest, CASE WHEN own IS NULL THEN 'LOST' WHEN own <> f.digest THEN 'MISNAMED'
  WHEN l.digest IS NULL THEN 'UNLISTED' ELSE 'OK' END AS verdict FROM f FULL JOIN l ON f.digest = l.digest""")
def q_archive_audit(spark, d):
    k = F.col("o_orderkey")
    digest = F.sha2(k.cast("string"), 256)
    o = table(spark, d, "orders")
    name = F.concat(F.when(k % 6 == 0, F.concat(F.lit("bad"), k.cast("string"))).otherwise(digest), F.lit(".pdf"))
    return archive_audit(o.where("o_orderkey % 4 <> 0").select(name.alias("name"), k.cast("string").cast("binary").alias("content")), o.where("o_orderkey % 5 <> 0").select(digest.alias("digest")))
