"""Queries over the tables of the collection domain: plan, resume, verify, judge, reconcile, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.paths import canonical_path, location
from tallyloom.functions.text import call_arguments, clean_component, disposition_name, looks_like_html, normalize_label, safe_params, url_problem, year_of_name
from tallyloom.functions.times import as_utc
from tallyloom.operators import contracts, manifest, planning, profiles, reconcile, skew, summaries
from tallyloom.sources.tables import table
from tallyloom.plans.problems import _sql_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _text(params):
    """Parameters as sorted ``key=value`` text."""
    pairs = F.array_sort(F.map_entries(params))
    return F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")


_SQL_TEXT = "array_to_string(list_transform(list_sort(map_keys({0})), lambda k: k || '=' || {0}[k]), '&')"


# --- planning -----------------------------------------------------------------------------------


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    asked = table(spark, sf_dir, "collection_tasks", "params").select(F.try_element_at("params", F.lit("svyYr")).alias("svyYr"), F.try_element_at("params", F.lit("schlId")).alias("schlId"))
    years = asked.select("svyYr").filter("svyYr is not null").distinct()
    schools = asked.filter("svyYr is not null and schlId is not null").distinct()
    divisions = table(spark, sf_dir, "school_codes", "schldivcd").select(F.col("schldivcd").alias("schlDivCd")).distinct()
    return years, schools, divisions


_ID = """'campus-' || left(sha256('{"data_id":"' || data_id || '","endpoint_url":"' || endpoint_url || '","operation":"' || operation || '","params":[' ||
  array_to_string(list_transform(list_sort(map_keys(params)), lambda k: '["' || k || '","' || params[k] || '"]'), ',') ||
  '],"scope_strategy":"' || scope_strategy || '","service":"' || service || '"}'), 24)"""
_GRID = f"""
  WITH asked AS (SELECT DISTINCT params['svyYr'] AS y, params['schlId'] AS s FROM collection_tasks),
  years AS (SELECT DISTINCT y FROM asked WHERE y IS NOT NULL), schools AS (SELECT y, s FROM asked WHERE y IS NOT NULL AND s IS NOT NULL),
  divisions AS (SELECT DISTINCT schldivcd AS d FROM school_codes),
  e AS (SELECT *, coalesce(fixed_params, MAP()::MAP(VARCHAR, VARCHAR)) AS f FROM endpoint_catalog),
  grid AS (
    SELECT e.*, map_concat(f, MAP {{'schlId': s, 'svyYr': y}}) AS params FROM e, schools WHERE scope_strategy = 'per_school_by_year'
    UNION ALL SELECT e.*, map_concat(f, MAP {{'svyYr': y}}) FROM e, years WHERE scope_strategy IN ('nationwide_by_year', 'lookup_by_year')
    UNION ALL SELECT e.*, map_concat(f, MAP {{'schlDivCd': d}}) FROM e, divisions WHERE scope_strategy = 'regional_by_school_type'
    UNION ALL SELECT e.*, f FROM e WHERE scope_strategy IN ('regional_all_school_types', 'lookup_once')),
  tasks AS (SELECT DISTINCT {_ID} AS task_id, service, operation, scope_strategy, {_SQL_TEXT.format("params")} AS request FROM grid)"""


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.expand(planning.distinct_endpoints(table(spark, sf_dir, "endpoint_catalog")), *_dimensions(spark, sf_dir), prefix="campus-")


@query(f"{_GRID} SELECT * FROM tasks")
def plan_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("task_id", "service", "operation", "scope_strategy", _text("params").alias("request"))


@query(f"""{_GRID.replace("schools AS (SELECT y, s FROM asked WHERE y IS NOT NULL AND s IS NOT NULL)", "schools AS (SELECT y, schlid AS s FROM years, (SELECT DISTINCT schlid FROM school_codes WHERE schlid IS NOT NULL))")} SELECT * FROM tasks""")
def plan_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of all schools of the code list in every year, whether tasks were planned for them or not."""
    years, _, divisions = _dimensions(spark, sf_dir)
    codes = table(spark, sf_dir, "school_codes", "schlid").filter("schlid is not null").select(F.col("schlid").alias("schlId")).distinct()
    schools = codes.withColumn("svyYr", F.explode(F.array(*(F.lit(y) for y in sorted(r.svyYr for r in years.collect())))))
    grid = planning.expand(planning.distinct_endpoints(table(spark, sf_dir, "endpoint_catalog")), years, schools, divisions, prefix="campus-")
    return grid.select("task_id", "service", "operation", "scope_strategy", _text("params").alias("request"))


@query(f"""{_GRID} SELECT count(*) AS planned, count(DISTINCT (service, operation)) AS operations, count(DISTINCT service) AS services,
  (SELECT string_agg(y, ',' ORDER BY y) FROM years) AS years FROM tasks""")
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.plan_summary(_grid(spark, sf_dir))


@query(f"SELECT task_id, {_ID} AS content_id FROM collection_tasks")
def plan_task_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "collection_tasks").select("task_id", planning.task_id("campus-").alias("content_id"))


@query("""SELECT operation, count(DISTINCT service) AS services FROM endpoint_catalog GROUP BY operation HAVING count(DISTINCT service) > 1""")
def plan_shared_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "endpoint_catalog", "service", "operation")
    return rows.groupBy("operation").agg(F.countDistinct("service").alias("services")).filter("services > 1")


@query("""SELECT DISTINCT t.params['svyYr'] AS "svyYr" FROM collection_tasks t
  WHERE t.params['svyYr'] IS NOT NULL AND t.params['svyYr'] NOT IN (SELECT svyyr FROM school_codes WHERE svyyr IS NOT NULL)""")
def plan_missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    years, _, _ = _dimensions(spark, sf_dir)
    return planning.missing_years(years, table(spark, sf_dir, "school_codes", "svyyr").select(F.col("svyyr").alias("svyYr")))


@query("""SELECT service, operation, task_id, row_number() OVER (PARTITION BY service ORDER BY operation, task_id) AS ordinal, count(*) OVER (PARTITION BY service) AS planned FROM collection_tasks""")
def plan_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.numbered(table(spark, sf_dir, "collection_tasks", "service", "operation", "task_id"), ["service"], ["operation", "task_id"])


@query("SELECT service, operation, task_id FROM collection_tasks ORDER BY service, operation, task_id LIMIT 25")
def plan_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tasks in order: a top-k, not a sort of the whole table."""
    return table(spark, sf_dir, "collection_tasks", "service", "operation", "task_id").orderBy("service", "operation", "task_id").limit(25)


@query(f"""WITH r AS (SELECT service, operation, map_concat(MAP {{'pageNo': '1', 'numOfRows': '1'}}, coalesce(fixed_params, MAP()::MAP(VARCHAR, VARCHAR)),
    CASE scope_strategy WHEN 'per_school_by_year' THEN MAP {{'svyYr': '2025', 'schlId': '0000001'}} WHEN 'nationwide_by_year' THEN MAP {{'svyYr': '2025'}}
      WHEN 'lookup_by_year' THEN MAP {{'svyYr': '2025'}} WHEN 'regional_by_school_type' THEN MAP {{'schlDivCd': '01'}} ELSE MAP()::MAP(VARCHAR, VARCHAR) END) AS p FROM endpoint_catalog)
  SELECT service, operation, {_SQL_TEXT.format("p")} AS request FROM r""")
def plan_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = planning.request_params(F.col("scope_strategy"), F.lit("2025"), F.lit("0000001"), F.lit("01"), F.col("fixed_params"))
    return table(spark, sf_dir, "endpoint_catalog", "service", "operation", "scope_strategy", "fixed_params").select("service", "operation", _text(params).alias("request"))


# --- resuming and verification -------------------------------------------------------------------


@query("SELECT task_id, service, operation FROM collection_tasks WHERE task_id IN (SELECT task_id FROM manifest_records)")
def resume_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.skipped(table(spark, sf_dir, "collection_tasks", "task_id", "service", "operation"), table(spark, sf_dir, "manifest_records", "task_id"))


@query("SELECT task_id, service, operation FROM collection_tasks t WHERE NOT EXISTS (SELECT 1 FROM manifest_records m WHERE m.task_id = t.task_id)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.pending(table(spark, sf_dir, "collection_tasks", "task_id", "service", "operation"), table(spark, sf_dir, "manifest_records", "task_id"))


@query("""SELECT service, CASE WHEN task_id IN (SELECT task_id FROM manifest_records) THEN 'skipped' ELSE 'pending' END AS status, count(*) AS tasks FROM collection_tasks GROUP BY ALL""")
def resume_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = manifest.with_status(table(spark, sf_dir, "collection_tasks", "task_id", "service"), table(spark, sf_dir, "manifest_records", "task_id"))
    return tasks.groupBy("service", "status").agg(F.count("*").alias("tasks"))


@query("SELECT task_id, count(DISTINCT sha256) AS digests FROM manifest_records WHERE task_id IS NOT NULL GROUP BY task_id HAVING count(DISTINCT sha256) > 1")
def manifest_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.conflicts(table(spark, sf_dir, "manifest_records", "task_id", "sha256"))


@query("SELECT task_id, max(entry_no) AS entry_no, arg_max(local_path, entry_no) AS local_path FROM portal_manifest WHERE status = 'downloaded' AND task_id IS NOT NULL GROUP BY task_id")
def manifest_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.last_wins(table(spark, sf_dir, "portal_manifest", "task_id", "entry_no", "local_path", "status"), "task_id", ["entry_no"], "status = 'downloaded'").drop("status")


@query("SELECT task_id, record_id, sha256 FROM manifest_records WHERE task_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY record_id) = 1")
def manifest_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.first_wins(table(spark, sf_dir, "manifest_records", "task_id", "record_id", "sha256"), "task_id", ["record_id"])


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest live row of each file of the store."""
    rows = table(spark, sf_dir, "stored_files", "file_no", "path", "size_bytes", "sha256", "stored_at", "deleted_at").filter("deleted_at is null and path is not null")
    keyed = rows.select(location(F.col("path")).alias("file_key"), F.col("size_bytes").alias("fact_size"), F.col("sha256").alias("fact_digest"), "stored_at", "file_no")
    return manifest.last_wins(keyed, "file_key", ["stored_at", "file_no"]).select("file_key", "fact_size", "fact_digest")


_FACTS = f"""facts AS (SELECT {_sql_path("path")} AS k, size_bytes, sha256 FROM stored_files WHERE deleted_at IS NULL AND path IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY stored_at DESC NULLS LAST, file_no DESC) = 1)"""


@query(f"""WITH {_FACTS}, m AS (SELECT record_id, {_sql_path("raw_path")} AS k, bytes, sha256 FROM manifest_records WHERE raw_path IS NOT NULL)
  SELECT record_id, CASE WHEN f.k IS NULL THEN 'missing' WHEN m.bytes <> f.size_bytes THEN 'changed size' WHEN m.sha256 <> f.sha256 THEN 'changed content' ELSE 'verified' END AS finding
  FROM m LEFT JOIN facts f ON m.k = f.k""")
def manifest_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "record_id", "raw_path", "bytes", "sha256").filter("raw_path is not null").withColumn("file_key", location(F.col("raw_path")))
    return manifest.verified(rows, _facts(spark, sf_dir)).select("record_id", "finding")


@query(f"""WITH {_FACTS},
  m AS (SELECT {_sql_path("raw_path")} AS k, count(DISTINCT sha256) AS digests, list(DISTINCT sha256) AS shas FROM manifest_records WHERE raw_path IS NOT NULL GROUP BY k),
  r AS (SELECT response_id, {_sql_path("raw_path")} AS k, sha256 FROM raw_responses)
  SELECT response_id, CASE WHEN m.k IS NOT NULL AND m.digests > 1 THEN 'task conflict'
      WHEN m.k IS NOT NULL AND NOT coalesce(list_contains(m.shas, f.sha256), false) THEN 'integrity error'
      WHEN m.k IS NOT NULL AND coalesce(list_contains(m.shas, r.sha256), false) THEN 'skipped' WHEN m.k IS NOT NULL THEN 'task conflict'
      WHEN f.k IS NOT NULL AND coalesce(f.sha256 = r.sha256, false) THEN 'adopted' WHEN f.k IS NOT NULL THEN 'path conflict' ELSE 'stored' END AS decision
  FROM r LEFT JOIN m ON r.k = m.k LEFT JOIN facts f ON r.k = f.k""")
def publish_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = table(spark, sf_dir, "raw_responses", "response_id", "raw_path", "sha256").withColumn("file_key", canonical_path(F.col("raw_path")))
    known = table(spark, sf_dir, "manifest_records", "raw_path", "sha256").filter("raw_path is not null").select(location(F.col("raw_path")).alias("file_key"), F.col("sha256").alias("known"))
    recorded = known.groupBy("file_key").agg(F.min("known").alias("known"), F.max("known").alias("other"), F.count("*").alias("records"))
    joined = skew.join_unique(skew.join_unique(incoming, recorded, ["file_key"]), _facts(spark, sf_dir), ["file_key"])
    no = F.lit(False)
    digests = F.when(F.col("known") == F.col("other"), 1).when(F.col("known").isNotNull(), 2).otherwise(0)
    decision = manifest.publication(
        F.col("records").isNotNull(), digests, F.coalesce(F.col("known") == F.col("sha256"), no), F.coalesce(F.col("known") == F.col("fact_digest"), no),
        F.col("fact_digest").isNotNull(), F.coalesce(F.col("fact_digest") == F.col("sha256"), no),
    )
    return joined.select("response_id", decision.alias("decision"))


# --- contracts --------------------------------------------------------------------------------------

_RESPONSE = """CASE WHEN http_status IS DISTINCT FROM 200 THEN 'unexpected status' WHEN result_code IS DISTINCT FROM '00' THEN 'unexpected result code'
  WHEN total_count IS NULL THEN 'no numeric total' WHEN item_count IS DISTINCT FROM total_count THEN 'unexpected number of items' END"""


@query(f"SELECT response_id, {_RESPONSE} AS failure FROM raw_responses WHERE failure IS NOT NULL")
def contract_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of responses."""
    rows = table(spark, sf_dir, "raw_responses", "response_id", "http_status", "result_code", "total_count", "item_count")
    return contracts.split(rows, contracts.response_failure())[1].select("response_id", "failure")


@query("""SELECT record_id, CASE WHEN row_count = 0 AND len(field_names) > 0 THEN 'fields without items'
    WHEN row_count > 0 AND len(list_filter(field_names, lambda x: NOT list_contains(output_fields, x))) > 0 THEN 'undeclared fields' END AS failure,
    array_to_string(list_sort(list_distinct(list_filter(field_names, lambda x: NOT list_contains(output_fields, x)))), ',') AS undeclared
  FROM manifest_records JOIN endpoint_catalog USING (service, operation) WHERE field_names IS NOT NULL AND failure IS NOT NULL""")
def contract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose fields the catalogue does not declare. The catalogue is joined as it is; AQE sends it whole if it is small."""
    rows = table(spark, sf_dir, "manifest_records", "record_id", "service", "operation", "row_count", "field_names").filter("field_names is not null")
    declared = table(spark, sf_dir, "endpoint_catalog", "service", "operation", "output_fields")
    joined = rows.join(declared, ["service", "operation"])
    failure = contracts.field_failure(F.col("field_names"), F.col("output_fields"), F.col("row_count"))
    undeclared = F.array_join(F.array_sort(F.array_except("field_names", "output_fields")), ",")
    return joined.select("record_id", failure.alias("failure"), undeclared.alias("undeclared")).filter("failure is not null")


@query("""SELECT record_id, CASE WHEN field_names IS NULL THEN 'no field names' WHEN len(list_filter(field_names, lambda x: x IS NULL OR trim(x) = '')) > 0 THEN 'blank field name'
    WHEN len(list_distinct(field_names)) <> len(field_names) THEN 'repeated field name' WHEN field_names <> list_sort(field_names) THEN 'unsorted field names'
    WHEN column_count IS DISTINCT FROM len(field_names) THEN 'column count differs'
    WHEN coalesce(duplicate_row_count < 0 OR duplicate_row_count > row_count, true) THEN 'duplicate count out of range' ELSE 'valid' END AS failure FROM manifest_records""")
def contract_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "record_id", "field_names", "column_count", "duplicate_row_count", "row_count")
    return rows.select("record_id", F.coalesce(contracts.shape_failure(), F.lit("valid")).alias("failure"))


_URL = r"""CASE WHEN coalesce(endpoint_url, '') = '' THEN 'empty' WHEN NOT regexp_matches(endpoint_url, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]+') THEN 'not http'
  WHEN regexp_matches(endpoint_url, '^[^/]+//[^/?#]*@') THEN 'user information' WHEN contains(endpoint_url, '?') THEN 'query' WHEN contains(endpoint_url, '#') THEN 'fragment' END"""


@query(f"""WITH j AS (SELECT CASE WHEN {_URL} IS NOT NULL THEN 'endpoint address' WHEN NOT coalesce(http_status BETWEEN 100 AND 599, false) THEN 'status out of range'
    WHEN NOT coalesce(regexp_matches(sha256, '^[0-9a-f]{{64}}$'), false) THEN 'checksum format' WHEN coalesce(bytes < 0, false) THEN 'negative size'
    WHEN coalesce(total_count < 0, false) THEN 'negative total' ELSE 'valid' END AS failure FROM manifest_records)
  SELECT failure, count(*) AS records FROM j GROUP BY failure""")
def contract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "endpoint_url", "http_status", "sha256", "bytes", "total_count")
    return rows.select(F.coalesce(contracts.record_failure(), F.lit("valid")).alias("failure")).groupBy("failure").agg(F.count("*").alias("records"))


@query("SELECT response_id, total_count FROM raw_responses WHERE total_count IS NOT NULL")
def contract_row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.within_limit(table(spark, sf_dir, "raw_responses", "response_id", "total_count").filter("total_count is not null"), "total_count", 70_000)


_SCOPE = """CASE scope_strategy WHEN 'per_school_by_year' THEN ['schlId', 'svyYr'] WHEN 'nationwide_by_year' THEN ['svyYr'] WHEN 'lookup_by_year' THEN ['svyYr']
  WHEN 'regional_by_school_type' THEN ['schlDivCd'] ELSE [] END"""


@query(f"""SELECT service, operation, array_to_string(list_sort(list_filter(map_keys(params), lambda k: list_contains({_SCOPE}, k))), ',') AS clashes, count(*) AS rows
  FROM collection_tasks WHERE clashes <> '' GROUP BY ALL""")
def contract_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of fixed parameters, on the full parameters of tasks: those of the strategy are reported."""
    rows = table(spark, sf_dir, "collection_tasks", "service", "operation", "scope_strategy", "params").withColumnRenamed("params", "fixed_params")
    clashes = planning.parameter_clashes(rows).withColumn("clashes", F.array_join("clashes", ","))
    return clashes.groupBy("service", "operation", "clashes").agg(F.count("*").alias("rows"))


# --- profiles ---------------------------------------------------------------------------------------


@query()
def profile_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both readings of each XML payload."""
    return profiles.xml_profiles(table(spark, sf_dir, "raw_responses", "response_id", "payload"), "response_id", "payload")


@query()
def profile_exact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and exact repeats of each XML payload, by the digests of its rows."""
    return profiles.exact_duplicates(profiles.exact_rows(table(spark, sf_dir, "raw_responses", "response_id", "payload"), "response_id", "payload"), "response_id")


@query("""SELECT count(*) AS rows, count(DISTINCT service) AS services, count(DISTINCT (service, operation)) AS pairs,
  CASE WHEN pairs <> rows THEN 'repeated operation' WHEN rows <> 48 THEN 'unexpected number of operations' WHEN services <> 7 THEN 'unexpected number of services' END AS failure FROM endpoint_catalog""")
def contract_catalogue_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.catalogue_contract(table(spark, sf_dir, "endpoint_catalog", "service", "operation"), 48, 7)


@query("""SELECT unnest(['answered', 'normal', 'counted', 'whole']) AS rule, count(*) AS rows, unnest([count(*) FILTER (WHERE http_status IS DISTINCT FROM 200), count(*) FILTER (WHERE result_code IS DISTINCT FROM '00'),
  count(*) FILTER (WHERE total_count IS NULL), count(*) FILTER (WHERE NOT coalesce(item_count = total_count, false))]) AS failed FROM raw_responses""")
def contract_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite of rules over all responses."""
    rows = table(spark, sf_dir, "raw_responses", "http_status", "result_code", "total_count", "item_count")
    return contracts.assertions(rows, answered=F.col("http_status") == 200, normal=F.col("result_code") == "00", counted=F.col("total_count").isNotNull(), whole=F.col("item_count") == F.col("total_count"))


@query("SELECT response_id, octet_length(encode(payload)) AS bytes, sha256(payload) AS digest FROM raw_responses WHERE payload IS NOT NULL")
def profile_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.file_facts(table(spark, sf_dir, "raw_responses", "response_id", "payload").filter("payload is not null"), "payload").drop("payload")


@query("SELECT lang, count(*) AS rows, count(*) - count(DISTINCT coalesce(sha256(text), '')) AS duplicate_rows FROM documents GROUP BY lang")
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.duplicate_rows(table(spark, sf_dir, "documents", "lang", "text"), ["lang"], "text")


@query("""SELECT service, operation, array_to_string(list_sort(list(DISTINCT f)), ',') AS field_union, count(DISTINCT f) AS fields
  FROM (SELECT service, operation, unnest(field_names) AS f FROM manifest_records) GROUP BY service, operation""")
def profile_field_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "service", "operation", "field_names").select("service", "operation", F.explode(F.array_distinct("field_names")).alias("f"))
    return rows.groupBy("service", "operation").agg(F.array_join(F.array_sort(F.collect_set("f")), ",").alias("field_union"), F.countDistinct("f").alias("fields"))


@query("SELECT svyyr, schldivcd, count(*) AS schools, list_sort(list(DISTINCT schlid))[1] AS first_school, count(DISTINCT schlid) AS distinct_schools FROM school_codes GROUP BY svyyr, schldivcd")
def profile_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "school_codes", "svyyr", "schldivcd", "schlid")
    return rows.groupBy("svyyr", "schldivcd").agg(F.count("*").alias("schools"), F.min("schlid").alias("first_school"), F.countDistinct("schlid").alias("distinct_schools"))


# --- reconciliation and sets ------------------------------------------------------------------------


@query("""SELECT e.service, e.operation, e.expected, coalesce(a.actual, 0) AS actual, e.expected = coalesce(a.actual, 0) AS agrees
  FROM (SELECT service, operation, count(*) AS expected FROM collection_tasks GROUP BY ALL) e
  LEFT JOIN (SELECT service, operation, count(DISTINCT task_id) AS actual FROM manifest_records WHERE task_id IS NOT NULL GROUP BY ALL) a USING (service, operation)""")
def reconcile_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "collection_tasks", "service", "operation").groupBy("service", "operation").agg(F.count("*").alias("expected"))
    actual = table(spark, sf_dir, "manifest_records", "service", "operation", "task_id").filter("task_id is not null").distinct()
    return reconcile.expected_counts(expected, actual, ["service", "operation"])


_LABEL = r"regexp_replace(regexp_replace(trim(regexp_replace(label, '\s+', ' ', 'g')), ':+$', ''), ' +$', '')"


@query(rf"""WITH s AS (SELECT DISTINCT group_code, series FROM kess_files WHERE series IS NOT NULL), f AS (SELECT entry_no, group_code, {_LABEL} AS label FROM kess_files)
  SELECT f.entry_no, f.label, CASE WHEN s.series IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping
  FROM f LEFT JOIN s ON f.group_code = s.group_code AND f.label = s.series WHERE f.group_code IN (SELECT group_code FROM s)""")
def reconcile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "kess_files", "entry_no", "group_code", "label").withColumn("label", normalize_label(F.col("label")))
    series = table(spark, sf_dir, "kess_files", "group_code", "series").filter("series is not null").select("group_code", F.col("series").alias("label")).distinct()
    return reconcile.mapped(files, series, "group_code", "label").select("entry_no", "label", "mapping")


@query("SELECT file_id, remote_name, snapshot_at, count(*) AS times FROM kess_files GROUP BY ALL HAVING count(*) > 1")
def reconcile_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.repeated(table(spark, sf_dir, "kess_files", "file_id", "remote_name", "snapshot_at"), ["file_id", "remote_name", "snapshot_at"])


@query("SELECT file_id, snapshot_at, entry_no FROM kess_files QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY snapshot_at, entry_no) = 1")
def reconcile_first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.first_match(table(spark, sf_dir, "kess_files", "file_id", "snapshot_at", "entry_no"), ["file_id"], ["snapshot_at", "entry_no"])


@query("SELECT source, count(*) AS files, count(DISTINCT domn_code) AS codes FROM portal_manifest WHERE status = 'downloaded' GROUP BY source")
def reconcile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "portal_manifest", "source", "domn_code", "status").filter("status = 'downloaded'")
    return rows.groupBy("source").agg(F.count("*").alias("files"), F.countDistinct("domn_code").alias("codes"))


@query("SELECT DISTINCT schlid FROM school_codes WHERE schlid NOT IN (SELECT params['schlId'] FROM manifest_records WHERE params['schlId'] IS NOT NULL)")
def set_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schools of the universe that no response was asked for."""
    asked = table(spark, sf_dir, "manifest_records", "params").select(F.try_element_at("params", F.lit("schlId")).alias("schlid")).filter("schlid is not null")
    return reconcile.unknown(table(spark, sf_dir, "school_codes", "schlid"), asked, "schlid")


@query("""WITH a AS (SELECT DISTINCT task_id FROM collection_tasks), b AS (SELECT DISTINCT task_id FROM manifest_records WHERE task_id IS NOT NULL), j AS (SELECT a.task_id AS l, b.task_id AS r FROM a FULL JOIN b ON a.task_id = b.task_id)
  SELECT count(*) FILTER (WHERE r IS NULL) AS only_left, count(*) FILTER (WHERE l IS NULL) AS only_right, only_left = 0 AND only_right = 0 AS equal FROM j""")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.same_set(table(spark, sf_dir, "collection_tasks", "task_id"), table(spark, sf_dir, "manifest_records", "task_id").filter("task_id is not null"), "task_id")


@query("""SELECT group_code, series, file_year, entry_no, row_number() OVER (PARTITION BY group_code ORDER BY series NULLS FIRST, file_year DESC NULLS LAST, entry_no) AS ordinal, count(*) OVER (PARTITION BY group_code) AS planned FROM kess_files""")
def order_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every file in the mixed order of its group."""
    rows = table(spark, sf_dir, "kess_files", "group_code", "series", "file_year", "entry_no")
    return skew.numbered(rows, ["group_code"], ["series", F.desc_nulls_last("file_year"), "entry_no"])


# --- summaries --------------------------------------------------------------------------------------

_RUN = """SELECT t.task_id, CASE WHEN m.task_id IS NULL THEN 'skipped' WHEN m.code = '00' THEN 'stored' ELSE 'failed' END AS status, coalesce(m.n, 0) AS requests
  FROM collection_tasks t LEFT JOIN (SELECT task_id, arg_max(coalesce(result_code, ''), record_id) AS code, count(*) AS n FROM manifest_records WHERE task_id IS NOT NULL GROUP BY task_id) m ON t.task_id = m.task_id"""


@query(f"""WITH r AS ({_RUN}) SELECT count(*) AS planned, count(*) FILTER (WHERE status <> 'failed') AS completed, count(*) FILTER (WHERE status = 'stored') AS stored,
  count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'failed') AS failed, sum(requests)::BIGINT AS http_requests FROM r""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "task_id", "record_id", "result_code").filter("task_id is not null")
    last = rows.groupBy("task_id").agg(F.max_by(F.coalesce("result_code", F.lit("")), "record_id").alias("code"), F.count("*").alias("n"))
    status = F.when(F.col("code").isNull(), "skipped").when(F.col("code") == "00", "stored").otherwise("failed")
    return summaries.run_summary(table(spark, sf_dir, "collection_tasks", "task_id").join(last, "task_id", "left").select(status.alias("status"), F.coalesce("n", F.lit(0)).alias("requests")))


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses with the service and operation that their path names."""
    parts = F.split(canonical_path(F.col("raw_path")), "/")
    rows = table(spark, sf_dir, "raw_responses", "raw_path", "total_count", "elapsed_ms", "result_code")
    return rows.select(parts[3].alias("service"), parts[4].alias("operation"), "total_count", "elapsed_ms", "result_code")


_PROBES = f"""p AS (SELECT split_part({_sql_path("raw_path")}, '/', 4) AS service, split_part({_sql_path("raw_path")}, '/', 5) AS operation, total_count, elapsed_ms, result_code FROM raw_responses)"""


@query(f"""WITH {_PROBES} SELECT service, count(*) AS operations, count(*) FILTER (WHERE total_count > 0) AS with_rows, count(*) FILTER (WHERE total_count = 0) AS zero_rows,
  list_sort(list(elapsed_ms) FILTER (WHERE elapsed_ms IS NOT NULL))[count(elapsed_ms) // 2 + 1] AS median_ms FROM p GROUP BY service""")
def service_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.service_summary(_probes(spark, sf_dir))


@query(f"""WITH {_PROBES} SELECT count(DISTINCT service) AS services, count(DISTINCT (service, operation)) AS operations, count(*) FILTER (WHERE result_code = '00') AS passed,
  count(*) FILTER (WHERE result_code = '00') || '/' || count(*) AS passed_ratio, count(*) FILTER (WHERE total_count = 0) || '/' || count(*) AS zero_ratio,
  bool_and(coalesce(result_code = '00', false)) AS all_passed, bool_or(coalesce(result_code = '00', false)) AS any_passed FROM p""")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.validation_summary(_probes(spark, sf_dir))


@query(f"""WITH {_PROBES} SELECT service, count(*) FILTER (WHERE result_code = '00' AND total_count > 0) AS with_rows, count(*) FILTER (WHERE result_code = '00' AND NOT coalesce(total_count > 0, false)) AS zero_rows,
  count(*) FILTER (WHERE result_code IS DISTINCT FROM '00') AS failed, count(*) AS operations FROM p GROUP BY service""")
def outcome_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes by service as a table of counts."""
    return summaries.outcome_table(_probes(spark, sf_dir))


@query("""SELECT service, operation, CASE WHEN output_fields IS NULL OR len(output_fields) = 0 THEN 'no fields' WHEN len(list_filter(output_fields, lambda f: f IS NULL OR trim(f) = '')) > 0 THEN 'blank field'
  WHEN len(list_distinct(output_fields)) <> len(output_fields) THEN 'repeated field' ELSE 'valid' END AS failure FROM endpoint_catalog""")
def contract_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "endpoint_catalog", "service", "operation", "output_fields")
    return rows.select("service", "operation", F.coalesce(contracts.declared_fields_failure(), F.lit("valid")).alias("failure"))


# --- scalar functions ---------------------------------------------------------------------------------

_CLEAN = r"""coalesce(nullif(trim(regexp_replace({0}, '[\\/:*?"<>|\x00-\x1f]+', '_', 'g'), ' .'), ''), 'unnamed')"""


@query(f"SELECT file_no, {_CLEAN.format('filename')} AS cleaned FROM stored_files")
def name_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stored_files", "file_no", "filename").select("file_no", clean_component(F.col("filename")).alias("cleaned"))


@query(f"SELECT entry_no, {_CLEAN.format('display_name')} AS announced FROM kess_files")
def name_announced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as a server would announce them in a header, read back."""
    header = F.concat(F.lit("attachment; filename*=UTF-8''"), F.url_encode("display_name"))
    return table(spark, sf_dir, "kess_files", "entry_no", "display_name").select("entry_no", disposition_name(F.replace(header, F.lit("+"), F.lit("%20"))).alias("announced"))


@query(f"SELECT entry_no, {_LABEL} AS label FROM kess_files")
def name_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "kess_files", "entry_no", "label").select("entry_no", normalize_label(F.col("label")).alias("label"))


@query(r"""SELECT entry_no, CASE WHEN regexp_matches(display_name, '^20\d{2}') THEN left(display_name, 4)::INT WHEN regexp_matches(display_name, '^\d{2}년') THEN left(display_name, 2)::INT + 2000 END AS name_year FROM kess_files""")
def name_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "kess_files", "entry_no", "display_name").select("entry_no", year_of_name(F.col("display_name")).alias("name_year"))


@query("SELECT entry_no, file_id AS a, remote_name AS b, group_code AS c FROM kess_files")
def name_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quoted arguments of a call, as catalogue pages have it."""
    call = F.concat(F.lit("javascript:download('"), "file_id", F.lit("', '"), "remote_name", F.lit("','"), "group_code", F.lit("');"))
    found = call_arguments(call, "download", 3)
    return table(spark, sf_dir, "kess_files", "entry_no", "file_id", "remote_name", "group_code").select("entry_no", found[0].alias("a"), found[1].alias("b"), found[2].alias("c"))


@query(r"""SELECT doc_id, coalesce(starts_with(lower(regexp_replace(left(text, 512), '^\s+', '')), '<!doctype html') OR starts_with(lower(regexp_replace(left(text, 512), '^\s+', '')), '<html'), false) AS html FROM documents""")
def text_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", looks_like_html(F.col("text")).alias("html"))


@query(f"SELECT service, operation, {_URL} AS problem, regexp_extract(endpoint_url, '^https?://([^/]+)', 1) AS host FROM endpoint_catalog")
def url_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "endpoint_catalog", "service", "operation", "endpoint_url").select("service", "operation", url_problem(F.col("endpoint_url")).alias("problem"), F.parse_url("endpoint_url", F.lit("HOST")).alias("host"))


@query(f"SELECT record_id, {_SQL_TEXT.format('params')} AS request FROM manifest_records")
def params_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters after a secret was added and taken out again."""
    secret = F.map_concat("params", F.create_map(F.lit("Service-Key"), F.lit("x")))
    return table(spark, sf_dir, "manifest_records", "record_id", "params").select("record_id", _text(safe_params(secret)).alias("request"))


@query(f"SELECT file_no, {_sql_path('path')} AS location FROM stored_files")
def path_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stored_files", "file_no", "path").select("file_no", canonical_path(F.col("path")).alias("location"))


@query("SELECT record_id, strftime(collected_at::timestamptz AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS collected_utc FROM manifest_records")
def time_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "record_id", "collected_at")
    return rows.select("record_id", F.date_format(as_utc(rows, "collected_at"), "yyyy-MM-dd HH:mm:ss").alias("collected_utc"))
