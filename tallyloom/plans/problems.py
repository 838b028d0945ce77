"""Queries of the data-preparation problems that belong to the core, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.paths import location
from tallyloom.functions.times import as_utc
from tallyloom.operators import compaction, drift, nested, orphans
from tallyloom.session import cut, shared_folder
from tallyloom.sources.tables import table


_DATASET = ["service", "operation"]


def _years(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", *_DATASET, "params", *columns)
    return rows.withColumn("period", F.expr("try_cast(try_element_at(params, 'svyYr') as int)")).drop("params")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses with the one spelling of their path; a null path stays null."""
    rows = table(spark, sf_dir, "raw_responses", "response_id", "raw_path", "payload")
    return rows.select("response_id", F.when(F.col("raw_path").isNotNull(), location(F.col("raw_path"))).alias("file_key"), "payload")


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What the listings say of the fields, and the payloads of their values; both stored, as they are small and read often."""
    listings = _years(spark, sf_dir, "field_names")
    files = _years(spark, sf_dir, "raw_path", "field_names").filter("raw_path is not null and size(field_names) > 0").select(*_DATASET, "period", location(F.col("raw_path")).alias("file_key"))
    marked = drift.payload_marks(table(spark, sf_dir, "raw_responses", "raw_path", "payload"), F.col("raw_path"), "payload", location)
    return cut(drift.field_facts(listings, _DATASET, "field_names")), cut(drift.value_facts(marked, files, _DATASET))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(*_facts(spark, sf_dir), _DATASET).withColumnRenamed("period", "survey_year")


def p1_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fused schema of each operation and year."""
    facts, values = _facts(spark, sf_dir)
    return drift.fused_schema(facts, values, _DATASET).withColumnRenamed("period", "survey_year").withColumn("alternatives", F.array_join("alternatives", ","))


def p1_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind that the values of a field take on in a year and had not in the year before."""
    facts, values = _facts(spark, sf_dir)
    found = drift.appearing_alternatives(drift.fused_schema(facts, values, _DATASET), _DATASET).withColumn("before", F.array_join("before", ","))
    return found.join(drift.usual_paths(facts, values), "field").select(*_DATASET, F.col("period").alias("survey_year"), F.col("usual").alias("field_name"), "alternative", "before")


def p1_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each field was listed by operation and year."""
    facts = drift.field_facts(_years(spark, sf_dir, "field_names"), _DATASET, "field_names")
    return facts.groupBy(*_DATASET, F.col("period").alias("survey_year"), "field").agg(F.sum("listings").alias("listings"), F.count("*").alias("spellings"))


def p1_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of all responses at all levels in one table, with a branch for each kind.

    Responses that the manifest lacks have no operation, and those asked for without a survey year no
    year. What cannot be read is in ``p1_quarantine``.
    """
    facts, values = _facts(spark, sf_dir)
    usual = cut(drift.usual_paths(facts, values))
    renamed = cut(drift.final_paths(drift.final_names(cut(drift.schema_changes(facts, values, _DATASET)), _DATASET), values, usual, _DATASET))
    items = nested.entries(_payloads(spark, sf_dir), "file_key", "payload")
    files = _years(spark, sf_dir, "raw_path").filter("raw_path is not null").select(*_DATASET, "period", location(F.col("raw_path")).alias("file_key")).distinct()
    return drift.unified(items.join(files, "file_key", "left"), renamed, usual, _DATASET).withColumnRenamed("period", "survey_year")


def p1_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses that cannot be read, so that none is lost unseen."""
    return nested.unreadable(_payloads(spark, sf_dir), ["response_id", "file_key"], "payload")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_records", "record_id", "raw_path", "bytes")
    return compaction.listed(rows, "record_id", F.col("raw_path"), F.col("bytes"), location)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listing(spark, sf_dir)
    return compaction.repeats(rows, compaction.schedule(rows)).select(F.col("file_id").alias("record_id"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of the output groups."""
    return compaction.group_sizes(compaction.schedule(_listing(spark, sf_dir)))


def p2_planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file of the plan, once, by the row that it is taken from."""
    return compaction.schedule(_listing(spark, sf_dir)).files.select(F.col("file_id").alias("record_id"), "size_bytes")


def _compacted(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    listing = _listing(spark, sf_dir)
    plan = compaction.schedule(listing)
    plan = plan._replace(files=cut(plan.files))
    responses = table(spark, sf_dir, "raw_responses", "raw_path", "payload")
    contents = responses.filter("raw_path is not null").select(location(F.col("raw_path")).alias("file_key"), F.col("payload").alias("content"))
    folder = f"{shared_folder(spark).rstrip('/')}/compacted-{uuid.uuid4().hex}"
    return folder, compaction.publish(plan, compaction.compact(plan, contents, folder), folder)


def p2_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored responses written to few files in the shared folder: what each output file holds."""
    return _compacted(spark, sf_dir)[1].drop("output_path", "missing_path")


def p2_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the published files hold, read back: the row that a content is listed by, its bytes and its digest."""
    held = compaction.contents_of(spark, _compacted(spark, sf_dir)[0])
    return held.select(F.col("file_id").alias("record_id"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("digest"))


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    api = table(spark, sf_dir, "manifest_records", "record_id", "raw_path", "collected_at")
    portal = table(spark, sf_dir, "portal_manifest", "entry_no", "local_path", "downloaded_at")
    return orphans.references(api, "manifest_records", "record_id", F.col("raw_path"), as_utc(api, "collected_at"), location).unionByName(
        orphans.references(portal, "portal_manifest", "entry_no", F.col("local_path"), as_utc(portal, "downloaded_at"), location)
    )


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "stored_files", "path", "stored_at", "deleted_at")
    known = orphans.parents(files, F.col("path"), as_utc(files, "stored_at"), F.col("deleted_at"), location)
    return orphans.orphans(_references(spark, sf_dir), known)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("ref_table", "ref_id", "orphan_kind", "period")


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_counts(_orphans(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nested.flatten(table(spark, sf_dir, "raw_responses", "response_id", "payload"), "response_id", "payload", fields=False)
    return rows.select("response_id", "item_no", "major_no", "quota_no")


def _p5_level(path: str, numbers: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A declared level with a column for each field that any response has there."""
        responses = table(spark, sf_dir, "raw_responses", "response_id", "payload")
        layout = nested.discover(responses, "payload")
        return nested.table_of(responses, "response_id", "payload", layout, path).drop("ordinals", *({"item_no", "major_no", "quota_no"} - set(numbers)))

    return query


p5_items = _p5_level("", ["item_no"])
p5_majors = _p5_level("majorList/major", ["item_no", "major_no"])
p5_quotas = _p5_level("majorList/major/quotaList/quota", ["item_no", "major_no", "quota_no"])


def p5_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the responses: what lies above each, its rows, and the fields that they fill."""
    responses = table(spark, sf_dir, "raw_responses", "response_id", "payload")
    layout = nested.discover(responses, "payload")
    names = nested.declared()
    above = spark.createDataFrame([(names.get(t, t), names.get(p, p)) for t, p in layout.parents.items()], "level_table string, parent_table string")
    flat = nested.flatten(responses, "response_id", "payload", layout=layout)
    filled = flat.select("level_table", F.explode_outer(F.map_keys("fields")).alias("field"), "fields").groupBy("level_table", "field").agg(F.count("*").alias("entries"))
    rows = flat.groupBy("level_table").agg(F.count("*").alias("rows"))
    return rows.join(above, "level_table", "left").join(filled.filter("field is not null"), "level_table", "left").select("level_table", "parent_table", "rows", "field", "entries")


QUERIES = {"p1_found": p1_found, "p1_schema": p1_schema, "p1_alternatives": p1_alternatives, "p1_fields": p1_fields, "p1_quarantine": p1_quarantine, "p1_unified": p1_unified, "p5_found": p5_found, "p5_items": p5_items, "p5_majors": p5_majors, "p5_quotas": p5_quotas, "p5_tables": p5_tables, "p2_found": p2_found, "p2_groups": p2_groups, "p2_planned": p2_planned, "p2_compacted": p2_compacted, "p2_written": p2_written, "p3_found": p3_found, "p3_counts": p3_counts}


def _sql_path(column: str) -> str:
    """``canonical_path`` in DuckDB's SQL; two rounds of folding ``..`` are enough for the tables."""
    text = rf"replace(regexp_replace({column}, '^\s+|\s+$', '', 'g'), '\', '/')"
    text = rf"regexp_replace({text}, '^[Ff][Ii][Ll][Ee]:(//(localhost)?)?/', '/')"
    text = f"CASE WHEN starts_with({text}, '/') THEN {text} ELSE '/srv/collector/' || {text} END"
    text = rf"regexp_replace({text}, '/(\.?/)+', '/', 'g')"
    for _ in range(2):
        text = rf"regexp_replace({text}, '/[^/]+/\.\./', '/', 'g')"
    return f"regexp_replace({text}, '^/srv/collector/', '')"


_FILES = f"SELECT {_sql_path('path')} AS k, stored_at, deleted_at FROM stored_files"
_REFS = f"""
  SELECT 'manifest_records' AS ref_table, record_id AS ref_id, {_sql_path("raw_path")} AS k, (collected_at::timestamptz AT TIME ZONE 'UTC') AS t FROM manifest_records WHERE raw_path IS NOT NULL
  UNION ALL
  SELECT 'portal_manifest', entry_no, {_sql_path("local_path")}, (downloaded_at::timestamptz AT TIME ZONE 'UTC') FROM portal_manifest WHERE local_path IS NOT NULL"""
_ORPHANS = f"""
  WITH files AS ({_FILES}), refs AS ({_REFS}),
  known AS (SELECT k, min(stored_at) FILTER (WHERE deleted_at IS NULL) AS since FROM files WHERE k IS NOT NULL GROUP BY k),
  found AS (
    SELECT ref_table, ref_id, refs.k, strftime(t, '%Y-%m') AS period,
      CASE WHEN known.k IS NULL THEN 'missing' WHEN since IS NULL THEN 'deleted' WHEN since > t THEN 'late' END AS orphan_kind
    FROM refs LEFT JOIN known ON refs.k = known.k)"""
SQL = {
    "p1_fields": r"""
      WITH listed AS (SELECT service, operation, try_cast(params['svyYr'] AS INT) AS survey_year, unnest(list_distinct(list_filter(field_names, lambda x: x IS NOT NULL))) AS name FROM manifest_records),
      plain AS (SELECT service, operation, survey_year, trim(regexp_replace(trim(name, E' \t\r\n'), '^\{[^}]*\}|^[^:]*:', ''), E' \t\r\n') AS spelling FROM listed WHERE survey_year IS NOT NULL)
      SELECT service, operation, survey_year, lower(spelling) AS field, count(*) AS listings, count(DISTINCT spelling) AS spellings FROM plain WHERE spelling <> '' GROUP BY ALL""",
    "p2_found": f"""
      WITH files AS (SELECT record_id, {_sql_path("raw_path")} AS k FROM manifest_records WHERE raw_path IS NOT NULL),
      firsts AS (SELECT k, min(record_id) AS first_id FROM files GROUP BY k)
      SELECT record_id FROM files JOIN firsts USING (k) WHERE record_id > first_id""",
    "p2_planned": f"""
      WITH files AS (SELECT record_id, bytes, {_sql_path("raw_path")} AS k FROM manifest_records WHERE raw_path IS NOT NULL)
      SELECT min(record_id) AS record_id, greatest(coalesce((list(bytes ORDER BY record_id))[1], max(bytes), 0), 0) AS size_bytes FROM files GROUP BY k""",
    "p2_written": f"""
      WITH files AS (SELECT min(record_id) AS record_id, {_sql_path("raw_path")} AS k FROM manifest_records WHERE raw_path IS NOT NULL GROUP BY k),
      held AS (SELECT DISTINCT {_sql_path("raw_path")} AS k, payload FROM raw_responses WHERE raw_path IS NOT NULL AND payload IS NOT NULL)
      SELECT record_id, octet_length(encode(payload)) AS bytes, sha256(payload) AS digest FROM files JOIN held USING (k)""",
    "p3_found": f"{_ORPHANS} SELECT ref_table, ref_id, orphan_kind, period FROM found WHERE orphan_kind IS NOT NULL",
    "p3_counts": f"""{_ORPHANS}
      SELECT ref_table, period, orphan_kind, count(*) AS orphan_refs, count(DISTINCT k) AS orphan_keys
      FROM found WHERE orphan_kind IS NOT NULL GROUP BY ALL""",
}
