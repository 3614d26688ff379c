"""Catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as ops
from .inputs import COLLECTIONS, collections, table
from .registry import query

ALL = f"WITH {COLLECTIONS} SELECT id, name"
OPEN = "FROM collections WHERE access = 'O' AND uploaded_by IS DISTINCT FROM 7 AND ipr IS DISTINCT FROM '1-URGENT'"


def _open(spark, d):
    return ops.visible_open(collections(spark, d), F.lit(7), "O", "1-URGENT")


@query(f"{ALL} FROM collections ORDER BY id DESC LIMIT 20")
def top_recent(spark, d):
    return ops.top_recent(collections(spark, d), 20).select("id", "name")


@query(f"{ALL} FROM collections WHERE use_case_id = 3 ORDER BY name")
def order_by_name(spark, d):
    return ops.by_name(collections(spark, d), 3).select("id", "name")


@query(f"{ALL} FROM collections ORDER BY id DESC LIMIT 1")
def last_item(spark, d):
    return ops.last_item(collections(spark, d), "id").select("id", "name")


@query(f"{ALL} {OPEN}")
def visible_open(spark, d):
    return _open(spark, d).select("id", "name")


@query(f"{ALL} FROM collections WHERE uploaded_by = 7")
def visible_mine(spark, d):
    return ops.visible_mine(collections(spark, d), F.lit(7)).select("id", "name")


@query(f"{ALL} FROM collections WHERE ipr = '2-HIGH'")
def visible_group(spark, d):
    return ops.visible_group(collections(spark, d).withColumn("group", F.col("ipr")), "2-HIGH").select("id", "name")


@query(f"{ALL} FROM collections WHERE use_case_id = 2")
def visible_usecase(spark, d):
    c = collections(spark, d)
    return ops.visible_usecase(c, c.select(F.col("id").alias("collection_id"), "use_case_id"), 2).select("id", "name")


@query("SELECT o_orderkey AS collection_id, n_name AS use_case FROM orders JOIN nation ON n_nationkey IN (o_orderkey % 5, o_orderkey % 7 + 5)")
def m2m_use_case(spark, d):
    """Collections with the names of all their use cases, through the bridge table."""
    k = F.col("o_orderkey")
    bridge = table(spark, d, "orders").select(k.alias("collection_id"), F.explode(F.array(k % 5, k % 7 + 5)).alias("use_case_id"))
    cases = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    return ops.use_cases(bridge, cases)


@query(f"{ALL} FROM collections WHERE uploaded_by = 7 UNION ALL SELECT id, name {OPEN} UNION ALL SELECT id, name FROM collections WHERE use_case_id = 2")
def visible_union(spark, d):
    c = collections(spark, d)
    lists = (ops.visible_mine(c, F.lit(7)), _open(spark, d), ops.visible_usecase(c, c.select(F.col("id").alias("collection_id"), "use_case_id"), 2))
    return ops.visible_union(*[x.select("id", "name") for x in lists])


@query(f"{ALL} FROM collections")
def admin_all(spark, d):
    return ops.visible_to(collections(spark, d), 7, True).select("id", "name")


@query(f"WITH {COLLECTIONS} SELECT access AS status, min(id) AS id FROM collections GROUP BY access")
def queue_pick(spark, d):
    return ops.queue_pick(collections(spark, d).withColumnRenamed("access", "status"), "status")


@query("SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS \"group\", o_orderkey AS id FROM customer JOIN orders ON c_custkey = o_custkey")
def user_profile_join(spark, d):
    profiles = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("group"))
    owned = table(spark, d, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("id"))
    return ops.user_profiles(owned, profiles).select("user_id", "name", "group", "id")


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1")
def sort_starttime(spark, d):
    return ops.days_in_order(table(spark, d, "orders"), "o_orderdate")


@query("SELECT DISTINCT 'SO2_' || (o_orderkey % 9) AS dir FROM orders")
def distinct_outputs(spark, d):
    return ops.distinct_outputs(table(spark, d, "orders").select(F.concat(F.lit("SO2_"), (F.col("o_orderkey") % 9).cast("string")).alias("dir")), "dir")


@query(f"WITH {COLLECTIONS} SELECT id, access, coverage_id FROM collections UNION ALL SELECT id + 10000000, 'P', 'new' FROM collections")
def catalog_clone_row(spark, d):
    c = collections(spark, d)
    return ops.clone_rows(c, F.lit(10_000_000), access=F.lit("P"), coverage_id=F.lit("new")).select("id", "access", "coverage_id")


@query(f"WITH {COLLECTIONS} SELECT id, CASE WHEN id % 3 = 0 THEN 'Available' ELSE access END AS access, CASE WHEN id % 3 = 0 THEN name || ' v2' ELSE name END AS name FROM collections")
def catalog_update(spark, d):
    c = collections(spark, d)
    changes = c.filter("id % 3 = 0").select("id", F.lit("Available").alias("access"), F.lit(" v2").alias("name"))
    return ops.update_rows(c, changes).select("id", "access", "name")


@query("SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'processing' WHEN 1 THEN 'Download_Error' WHEN 2 THEN 'uploading' ELSE 'uploading' END AS status FROM orders")
def state_machine(spark, d):
    items = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("uploading").alias("status"))
    event = F.get(F.array(F.lit("fetched"), F.lit("fetch_failed"), F.lit("synced")), (F.col("id") % 4).cast("int"))
    return ops.advance(items, items.select("id", event.alias("event")))


_MOVES = ", ".join(f"('{a}', '{e}', '{b}')" for a, e, b in ops.TRANSITIONS)
_NAMES = "fetched converted loaded synced failed sync_failed fetched".split()
_EVENTS = f"""items AS (SELECT o_orderkey AS id, 'uploading' AS status FROM orders),
ev AS (SELECT l_orderkey AS id, TIMESTAMP '2024-01-01' + to_hours(l_linenumber) + to_minutes(CAST(l_suppkey % 50 AS INT)) AS t, [{', '.join(map(repr, _NAMES))}][CASE WHEN l_partkey % 6 = 0 THEN l_partkey % 7 ELSE l_linenumber - 1 END + 1] AS event FROM lineitem),
e AS (SELECT DISTINCT * FROM ev), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, event) AS nth FROM e), m(was, event, next) AS (VALUES {_MOVES}),
f AS (SELECT id, CAST(0 AS BIGINT) AS nth, status, CAST(NULL AS TIMESTAMP) AS since, CAST(0 AS BIGINT) AS moves, CAST(0 AS BIGINT) AS lost FROM items UNION ALL
  SELECT f.id, n.nth, coalesce(next, status), CASE WHEN next IS NULL THEN since ELSE t END, moves + CASE WHEN next IS NULL THEN 0 ELSE 1 END, lost + CASE WHEN next IS NULL THEN 1 ELSE 0 END FROM f JOIN n ON n.id = f.id AND n.nth = f.nth + 1 LEFT JOIN m ON was = status AND m.event = n.event)"""


def _followed(spark, d):
    """Orders as items, their lines as events: late ones, repeated ones and such as don't fit."""
    items = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("uploading").alias("status"))
    k, n = F.col("l_partkey"), F.col("l_linenumber")
    name = F.get(F.array(*map(F.lit, _NAMES)), F.when(k % 6 == 0, k % 7).otherwise(n - 1).cast("int"))
    seconds = F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + n * 3600 + F.col("l_suppkey") % 50 * 60
    events = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.timestamp_seconds(seconds).alias("t"), name.alias("event"))
    return ops.follow(items, events)


@query(f"WITH RECURSIVE {_EVENTS} SELECT id, arg_max(status, nth) AS status, max(moves) AS n_moves, max(lost) AS n_rejected FROM f GROUP BY id")
def state_sequences(spark, d):
    return _followed(spark, d).select("id", "status", (F.size("path") - 1).cast("long").alias("n_moves"), F.size("rejected").cast("long").alias("n_rejected"))


@query(f"""WITH RECURSIVE {_EVENTS}, p AS (SELECT id, moves, any_value(status) AS status, any_value(since) AS since FROM f GROUP BY id, moves)
SELECT status, count(*) AS n, CAST(sum(seconds) AS BIGINT) AS seconds FROM (SELECT *, epoch(lead(since) OVER (PARTITION BY id ORDER BY moves)) - epoch(since) AS seconds FROM p) GROUP BY status""")
def state_times(spark, d):
    """How many items were in each state, and how long."""
    return _followed(spark, d).select(F.explode("path").alias("p")).groupBy("p.status").agg(F.count("*").alias("n"), F.sum("p.seconds").alias("seconds"))


@query(f"""WITH {COLLECTIONS}, o AS (SELECT id, 'cov' || CAST(k AS VARCHAR) || '_' || CAST(id % 7 AS VARCHAR) || '_v1_tif' AS c, '/m/' || CAST(k AS VARCHAR) AS loc FROM collections, range(3) t(k) WHERE k < id % 4),
n AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY c DESC) AS nth, CAST(id AS VARCHAR) || '/' || c || '/' || loc AS key FROM o),
x AS (SELECT *, 1000000 + row_number() OVER (ORDER BY substr(md5(key), 1, 3), key) AS new_id FROM n WHERE nth > 1)
SELECT id, name || CASE WHEN n > 1 THEN ' ' || regexp_replace(c, '_v1_tif$', '') ELSE '' END AS name, coalesce(c, coverage_id) AS coverage_id, coalesce(loc, '/up') AS location, CASE WHEN c IS NULL THEN 'processed' ELSE 'mwcs_processed' END AS status FROM collections LEFT JOIN (SELECT * FROM n WHERE nth = 1) USING (id)
UNION ALL SELECT new_id, name || ' ' || regexp_replace(c, '_v1_tif$', ''), c, loc, 'mwcs_processed' FROM x JOIN collections USING (id)""")
def upload_fan_out(spark, d):
    """Uploads that brought forth none to three coverages."""
    c = collections(spark, d).select("id", "name", "coverage_id", F.lit("/up").alias("location"), F.lit("processed").alias("status"))
    k = F.col("k").cast("string")
    outputs = c.select("id", F.explode(F.array(*map(F.lit, range(3)))).alias("k")).filter("k < id % 4")
    outputs = outputs.select("id", F.concat(F.lit("cov"), k, F.lit("_"), (F.col("id") % 7).cast("string"), F.lit("_v1_tif")).alias("coverage_id"), F.concat(F.lit("/m/"), k).alias("location"))
    return ops.fan_rows(c, outputs, 1_000_000, "mwcs_processed")
