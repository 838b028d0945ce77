"""The same operators over the star schema: grids, resuming, conflicts, contracts, first and last rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.ids import content_id, row_digest
from tallyloom.functions.text import ratio
from tallyloom.operators import contracts, manifest, reconcile
from tallyloom.operators.skew import upper_medians
from tallyloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


@query("SELECT n_name, y.svy_year FROM nation, (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS svy_year FROM orders) y")
def star_plan_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations by order years. Both sides are small by nature."""
    years = table(spark, sf_dir, "orders", "o_orderdate").select(F.year("o_orderdate").cast("string").alias("svy_year")).distinct()
    return table(spark, sf_dir, "nation", "n_name").join(years)


@query("""SELECT n_name, s.svy_year, s.c_mktsegment FROM nation n JOIN
  (SELECT DISTINCT c_nationkey, CAST(year(o_orderdate) AS VARCHAR) AS svy_year, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey) s ON n.n_nationkey = s.c_nationkey""")
def star_plan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    seen = orders.join(customers, orders.o_custkey == customers.c_custkey).select("c_nationkey", F.year("o_orderdate").cast("string").alias("svy_year"), "c_mktsegment").distinct()
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return seen.join(nations, seen.c_nationkey == nations.n_nationkey).select("n_name", "svy_year", "c_mktsegment")


@query("""SELECT o_orderkey, 'task-' || left(sha256('{"customer":"' || o_custkey || '","order":"' || o_orderkey || '"}'), 24) AS task_id FROM orders""")
def star_task_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = content_id("task-", order=F.col("o_orderkey").cast("string"), customer=F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select("o_orderkey", task.alias("task_id"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)")
def star_resume_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice").filter("o_orderstatus = 'F' and o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return manifest.skipped(table(spark, sf_dir, "customer", "c_custkey", "c_name"), done, "c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)")
def star_resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice").filter("o_orderstatus = 'F' and o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return manifest.pending(table(spark, sf_dir, "customer", "c_custkey", "c_name"), done, "c_custkey")


@query("SELECT l_orderkey, count(DISTINCT l_returnflag) AS digests FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1")
def star_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.conflicts(table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag"), "l_orderkey", "l_returnflag")


@query("""SELECT event_type, count(*) AS events, count(*) FILTER (WHERE value > 100) AS large, list_sort(list(value))[len(list(value)) // 2 + 1] AS median_value FROM events GROUP BY event_type""")
def star_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_type", "value")
    counts = rows.groupBy("event_type").agg(F.count("*").alias("events"), F.count_if(F.col("value") > 100).alias("large"))
    return counts.join(upper_medians(rows, ["event_type"], "value", "median_value"), "event_type")


@query("SELECT count(*) FILTER (WHERE value > 100) || '/' || count(*) AS large_ratio FROM events")
def star_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", "value").agg(ratio(F.col("value") > 100).alias("large_ratio"))


@query("SELECT user_id, max((ts, event_id))[2] AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def star_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.last_wins(table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def star_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.first_wins(table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k FROM events")
def star_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", "event_id", "props").select("event_id", F.from_json("props", "k long").k.alias("k"))


@query("SELECT DISTINCT unnest(json_keys(props::JSON)) AS key FROM events")
def star_json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", "props").select(F.explode(F.json_object_keys("props")).alias("key")).distinct()


@query("""SELECT r_name, 3 + r_regionkey AS expected, count(n_nationkey) AS actual, count(n_nationkey) = 3 + r_regionkey AS agrees FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name, r_regionkey""")
def star_expected_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations, against expectations that differ by region."""
    regions = table(spark, sf_dir, "region", "r_regionkey", "r_name").withColumn("expected", F.col("r_regionkey") + 3)
    nations = table(spark, sf_dir, "nation", "n_regionkey").withColumnRenamed("n_regionkey", "r_regionkey")
    return reconcile.expected_counts(regions, nations, ["r_regionkey"]).join(regions.select("r_regionkey", "r_name"), "r_regionkey").drop("r_regionkey")


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY user_id")
def star_field_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", "user_id", "event_type").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN 'quantity' WHEN l_discount > 0.09 THEN 'discount' WHEN l_tax > 0.07 THEN 'tax' ELSE 'accepted' END AS reason FROM lineitem""")
def star_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    reason = contracts.first_failure((F.col("l_quantity") > 45, "quantity"), (F.col("l_discount") > 0.09, "discount"), (F.col("l_tax") > 0.07, "tax"))
    return rows.select("l_orderkey", "l_linenumber", F.coalesce(reason, F.lit("accepted")).alias("reason"))


@query("""SELECT l_orderkey, array_to_string(list_sort(list_filter(list(DISTINCT l_returnflag), lambda x: NOT list_contains(['A', 'N'], x))), ',') AS undeclared FROM lineitem GROUP BY l_orderkey""")
def star_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"))
    return flags.select("l_orderkey", F.array_join(F.array_sort(F.array_except("f", F.array(F.lit("A"), F.lit("N")))), ",").alias("undeclared"))


@query("SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) = 1")
def star_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.first_match(table(spark, sf_dir, "lineitem", "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"])


@query("(SELECT p_brand, p_type FROM part WHERE p_size <= 25) INTERSECT (SELECT p_brand, p_type FROM part WHERE p_size > 25)")
def star_common_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_brand", "p_type", "p_size")
    return reconcile.common_rows(parts.filter("p_size <= 25").select("p_brand", "p_type"), parts.filter("p_size > 25").select("p_brand", "p_type"))


@query("SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 20")
def star_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", "o_orderpriority", "o_orderkey", "o_totalprice").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT 'nation' AS kind, n_name AS name FROM nation UNION ALL SELECT 'region', r_name FROM region")
def star_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation", "n_name").select(F.lit("nation").alias("kind"), F.col("n_name").alias("name"))
    return nations.unionByName(table(spark, sf_dir, "region", "r_name").select(F.lit("region").alias("kind"), F.col("r_name").alias("name")))


@query("""WITH d AS (SELECT doc_id, octet_length(encode(coalesce(source, ''))) AS n, coalesce(source, '') AS s FROM documents)
  SELECT doc_id, sha256(unhex('0000000000000006') || encode('source') || unhex(lpad(to_hex(n), 16, '0')) || encode(s)) AS digest FROM d""")
def star_row_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order-exact identity of a row given as name-value pairs."""
    pairs = F.array(F.struct(F.lit("source").alias("name"), F.col("source").alias("value")))
    return table(spark, sf_dir, "documents", "doc_id", "source").select("doc_id", row_digest(pairs).alias("digest"))
