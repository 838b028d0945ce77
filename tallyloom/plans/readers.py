"""Queries that take the tables through readers, sinks and driver-side checks: written out in the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.ids import content_id
from tallyloom.functions.text import disposition_name, fit_bytes, local_tag
from tallyloom.model import MANIFEST, MANIFEST_REQUIRED
from tallyloom.operators import contracts, planning, profiles, reconcile
from tallyloom.plans.collection import _CLEAN
from tallyloom.session import shared_folder
from tallyloom.sources import catalogues, manifests
from tallyloom.sources.tables import table
from tallyloom.streaming import tail

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_NAMES = [part.split()[0] for part in MANIFEST.split(", ")]
_WHOLE = " AND ".join(f"{n} IS NOT NULL" for n in MANIFEST_REQUIRED)


@query(f"SELECT task_id, raw_path, sha256, bytes, http_status, row_count, array_to_string(field_names, ',') AS fields, cardinality(params)::INT AS params FROM manifest_records WHERE {_WHOLE}")
def manifest_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete manifest rows, written as JSON lines and read back by the strict reader."""
    rows = table(spark, sf_dir, "manifest_records", *_NAMES).filter(_WHOLE)
    folder = _folder(spark, "manifest")
    rows.select(F.to_json(F.struct(*_NAMES))).write.text(folder)
    read = manifests.strict(spark, folder)
    return read.select("task_id", "raw_path", "sha256", "bytes", "http_status", "row_count", F.array_join("field_names", ",").alias("fields"), F.size("params").alias("params"))


@query("SELECT DISTINCT task_id, sha256 FROM manifest_records")
def manifest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as JSON lines through the stream, in two runs of it: each checksum of a task once, dated or in the quarantine."""
    rows = table(spark, sf_dir, "manifest_records", *_NAMES)
    folder = _folder(spark, "stream")
    for _ in range(2):  # the second run brings all rows again
        rows.select(F.to_json(F.struct(*_NAMES))).write.mode("append").text(f"{folder}/in")
        tail.run_once(tail.tail(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/state")
    held = [spark.read.schema("task_id string, sha256 string").parquet(f"{folder}/out{end}") for end in ("", "-quarantine")]
    return held[0].unionByName(held[1]).distinct()


@query("""SELECT task_id, arg_max(struct_pack(p := local_path), entry_no).p AS local_path, arg_max(struct_pack(s := size_bytes), entry_no).s AS size_bytes FROM portal_manifest WHERE status = 'downloaded' AND task_id <> '' GROUP BY task_id""")
def manifest_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portal manifest in the order of its entries as JSON lines, read back by the lenient reader: the last download of each task."""
    rows = table(spark, sf_dir, "portal_manifest", "entry_no", "task_id", "status", "local_path", "sha256", "size_bytes")
    folder = _folder(spark, "portal")
    rows.repartitionByRange("entry_no").sortWithinPartitions("entry_no").select(F.to_json(F.struct("task_id", "status", "local_path", "sha256", "size_bytes"))).write.text(folder)
    return manifests.lenient(spark, folder).select("task_id", "local_path", "size_bytes")


@query(r"""SELECT entry_no, regexp_replace(regexp_replace(trim(regexp_replace(coalesce(label, ''), '\s+', ' ', 'g')), ':+$', ''), ' +$', '') AS label, file_id, remote_name, display_name, group_code,
  CASE WHEN regexp_matches(display_name, '^20\d{2}') THEN left(display_name, 4)::INT WHEN regexp_matches(display_name, '^\d{2}년') THEN left(display_name, 2)::INT + 2000 END AS file_year
  FROM kess_files WHERE NOT contains(file_id || remote_name || display_name || group_code, '''')""")
def html_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every catalogue entry as a page, with a list around its own entry, read by the page reader. Names with the quotes of the call are no arguments."""
    rows = table(spark, sf_dir, "kess_files", "entry_no", "label", "file_id", "remote_name", "display_name", "group_code")
    escape = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    call = F.concat(F.lit("download('"), F.col("file_id"), F.lit("', '"), F.col("remote_name"), F.lit("', '"), F.col("display_name"), F.lit("','"), F.col("group_code"), F.lit("')"))
    page = F.concat(F.lit("<html><ul><li>2020<ul><li><span>2021</span><b>"), escape(F.coalesce("label", F.lit(""))), F.lit('</b><a onclick="'), escape(call), F.lit('">x</a></li></ul></li></ul>'))
    found = catalogues.html_files(rows.select("entry_no", page.alias("html")), ["entry_no"], "html")
    return found.withColumn("label", F.when(F.col("label") == "x", "").otherwise(F.col("label")))  # without a label the link's own text is the first


@query("""WITH files AS (SELECT domn_code, file_year, arg_min(coalesce(local_path, ''), entry_no) AS serial FROM portal_manifest GROUP BY ALL),
  wanted AS (SELECT DISTINCT domn_code, file_year FROM portal_manifest UNION ALL SELECT DISTINCT domn_code, '1900' FROM portal_manifest)
  SELECT domn_code, file_year, nullif(serial, '') AS serial, CASE WHEN serial IS NULL THEN 'year not available' WHEN serial = '' THEN 'no serial' END AS problem FROM wanted LEFT JOIN files USING (domn_code, file_year)""")
def files_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first file of every data set and year, and of a year that no data set has."""
    rows = table(spark, sf_dir, "portal_manifest", "domn_code", "file_year", "entry_no", "local_path")
    files = rows.select("domn_code", "file_year", F.col("entry_no").alias("position"), F.coalesce("local_path", F.lit("")).alias("serial"))
    wanted = rows.select("domn_code", "file_year").distinct().unionByName(rows.select("domn_code", F.lit("1900").alias("file_year")).distinct())
    found = catalogues.select_files(wanted, files, "domn_code")
    return found.withColumn("serial", F.nullif("serial", F.lit("")))


@query("SELECT DISTINCT source, domn_code, coalesce(dataset, '') AS dataset FROM portal_manifest")
def scope_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All data sets of the portal, checked against the number that each source has."""
    datasets = table(spark, sf_dir, "portal_manifest", "source", "domn_code", "dataset").select("source", "domn_code", F.coalesce("dataset", F.lit("")).alias("dataset")).distinct()
    expected = {r.source: r["count"] for r in datasets.groupBy("source").count().collect()}
    return reconcile.select_scope(datasets, expected)


@query("SELECT entry_no, source, status FROM portal_manifest WHERE status IS NOT NULL")
def rows_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portal's rows with an outcome, by a filter that is an error where nothing meets it."""
    rows = table(spark, sf_dir, "portal_manifest", "entry_no", "source", "status")
    known = [r.status for r in rows.filter("status is not null").select("status").distinct().collect()]
    return reconcile.filtered(rows, status=known, source=None)


@query("""WITH l AS (SELECT svyyr AS "svyYr", count(*) AS n, count(DISTINCT schlid) AS d, count(*) FILTER (WHERE coalesce(schlid, '') = '') AS blank FROM school_codes WHERE svyyr IS NOT NULL GROUP BY svyyr)
  SELECT "svyYr", n AS rows, d AS schools, CASE WHEN blank > 0 THEN 'item without school' WHEN n <> d THEN 'repeated school' END AS problem FROM l""")
def school_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of schools by year, judged by their rules."""
    rows = table(spark, sf_dir, "school_codes", "svyyr", "schlid").filter("svyyr is not null")
    items = rows.select(F.col("svyyr").alias("svyYr"), F.col("svyyr").alias("item_year"), F.col("schlid").alias("schlId"))
    counts = items.groupBy("svyYr").agg(F.count("*").alias("expected"))
    return profiles.school_lists(items, counts).withColumn("schools", F.size("schools").cast("long"))


@query("""SELECT response_id, CASE WHEN http_status IS DISTINCT FROM 200 THEN 'unexpected status' WHEN result_code IS DISTINCT FROM '00' THEN 'unexpected result code'
  WHEN total_count IS NULL THEN 'no numeric total' WHEN total_count <> item_count THEN 'total changed' WHEN item_count IS DISTINCT FROM least(total_count, 2) THEN 'unexpected number of items' ELSE 'valid' END AS failure FROM raw_responses""")
def contract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All responses as answers to a request for two rows, with what they hold as the announced total."""
    rows = table(spark, sf_dir, "raw_responses", "response_id", "http_status", "result_code", "total_count", "item_count")
    return rows.select("response_id", F.coalesce(contracts.response_failure(F.col("item_count"), F.lit(2)), F.lit("valid")).alias("failure"))


@query("""WITH n AS (SELECT p_partkey, repeat(p_name || ' .', 1 + (p_partkey % 40)::INT) || '.xlsx' AS name FROM part)
  SELECT p_partkey, CASE WHEN strlen(name) <= 240 THEN name ELSE rtrim(left(left(name, length(name) - 5), 235), ' .') || '.xlsx' END AS fitted FROM n""")
def name_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names up to far beyond the limit of bytes, cut before their suffix."""
    name = F.concat(F.repeat(F.concat("p_name", F.lit(" .")), (F.col("p_partkey") % 40 + 1).cast("int")), F.lit(".xlsx"))
    return table(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", fit_bytes(name).alias("fitted"))


@query(f"SELECT entry_no, CASE WHEN NOT regexp_matches(display_name, '[%\";]') THEN {_CLEAN.format('display_name')} END AS announced FROM kess_files")
def name_latin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as servers announce them whose UTF-8 is taken for Latin-1, repaired; null where signs of the header itself are in them."""
    header = F.concat(F.lit("attachment; filename="), F.decode(F.encode("display_name", "UTF-8"), "ISO-8859-1"))
    rows = table(spark, sf_dir, "kess_files", "entry_no", "display_name")
    return rows.select("entry_no", F.when(~F.col("display_name").rlike('[%";]'), disposition_name(header)).alias("announced"))


@query("""SELECT entry_no, 'name-' || left(sha256('{"name":' || to_json(display_name)::VARCHAR || '}'), 24) AS name_id FROM kess_files WHERE display_name IS NOT NULL""")
def name_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of names in any letters, from JSON that keeps them as they are."""
    rows = table(spark, sf_dir, "kess_files", "entry_no", "display_name").filter("display_name is not null")
    return rows.select("entry_no", content_id("name-", ascii_only=False, name=F.col("display_name")).alias("name_id"))


@query(r"""SELECT regexp_replace(f, '^.*\}', '') AS tag, count(*) AS uses FROM (SELECT unnest(field_names) AS f FROM manifest_records) GROUP BY tag""")
def field_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uses of each element name without its namespace."""
    rows = table(spark, sf_dir, "manifest_records", "field_names").select(F.explode("field_names").alias("f"))
    return rows.groupBy(local_tag(F.col("f")).alias("tag")).agg(F.count("*").alias("uses"))


@query("""SELECT task_id FROM collection_tasks ORDER BY service, operation, list_transform(list_sort(map_keys(params)), lambda k: [k, params[k]]), endpoint_url, task_id LIMIT 100""")
def plan_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred tasks to be run first."""
    return planning.in_order(table(spark, sf_dir, "collection_tasks")).limit(100).select("task_id")


@query("""WITH c AS (SELECT service, operation, count(DISTINCT (data_id, endpoint_url, scope_strategy, list_transform(list_sort(map_keys(params)), lambda k: [k, params[k]]))) AS variants FROM collection_tasks GROUP BY ALL)
  SELECT * FROM c WHERE variants > 1""")
def plan_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks taken for a catalogue: operations that are declared in several ways."""
    return planning.catalogue_conflicts(table(spark, sf_dir, "collection_tasks").withColumnRenamed("params", "fixed_params"))


@query("SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal >= 0")
def set_unknown_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders, most of them asked for many times, that have no balance in hand."""
    known = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return reconcile.unknown(table(spark, sf_dir, "orders", "o_custkey"), known, "o_custkey")


@query("SELECT l_orderkey, bool_and(l_quantity <= 45) AS same FROM lineitem GROUP BY l_orderkey")
def profile_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each order against themselves with large quantities cut."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate").withColumn("item_no", F.struct("l_linenumber", "l_partkey", "l_shipdate", "l_quantity"))
    pairs = lambda q: F.array(F.struct(F.lit("quantity").alias("name"), q.cast("string").alias("value")))
    left = rows.select("l_orderkey", "item_no", pairs(F.col("l_quantity")).alias("pairs"))
    right = rows.select("l_orderkey", "item_no", pairs(F.least("l_quantity", F.lit(45.0))).alias("pairs"))
    return profiles.same_responses(left, right, "l_orderkey")


@query("SELECT response_id, CAST(round_even(elapsed_ms / 1000.0, 1) AS DOUBLE) AS seconds, CAST(least(500 * power(2, attempts - 1), 300000) AS DOUBLE) AS pause_ms FROM raw_responses")
def time_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in tenths of seconds, halves to the even digit, and the pause that the last attempt would be followed by."""
    rows = table(spark, sf_dir, "raw_responses", "response_id", "attempts", "elapsed_ms")
    seconds = F.bround(F.col("elapsed_ms").cast("decimal(18,0)") / 1000, 1).cast("double")
    return rows.select("response_id", seconds.alias("seconds"), F.least(500 * F.pow(F.lit(2), F.col("attempts") - 1), F.lit(300_000.0)).alias("pause_ms"))
