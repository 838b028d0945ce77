"""From a declarative catalogue to a deterministic grid of tasks with content-derived ids.

Strategies differ only in the dimensions that they need. The rows of the dimensions carry the
strategies that they serve, so the grid is one join on the strategy. Each strategy is one hot key, so
the catalogue is sent whole if a count shows that it is small; else the dimensions are spread over
salts. Endpoints and dimensions are made distinct before the join, so the grid is unique by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.ids import content_id, sorted_pairs
from tallyloom.functions.text import SECRETS, normalized_key
from tallyloom.operators.skew import SALTS, SMALL_ROWS

#: The strategies, each with the parameters that a task of it has.
STRATEGIES = {
    "per_school_by_year": ("schlId", "svyYr"),
    "nationwide_by_year": ("svyYr",),
    "regional_by_school_type": ("schlDivCd",),
    "regional_all_school_types": (),
    "lookup_once": (),
    "lookup_by_year": ("svyYr",),
}
ENDPOINT = ["data_id", "service", "operation", "endpoint_url", "scope_strategy"]
TASK = ["task_id", *ENDPOINT[:3], "endpoint_url", "scope_strategy", "params"]


def distinct_strings(df: DataFrame, name: str) -> DataFrame:
    """The distinct values of a column, sorted; a null or empty one is an error when the plan runs."""
    checked = F.when(F.col(name).isNull() | (F.trim(name) == ""), F.raise_error(F.lit(f"{name} must not be empty"))).otherwise(F.col(name))
    return df.select(checked.alias(name)).distinct().orderBy(name)


def catalogue_conflicts(catalogue: DataFrame) -> DataFrame:
    """Keys that are declared more than once with different content."""
    content = F.sha2(F.to_json(F.struct(*ENDPOINT, sorted_pairs(F.col("fixed_params")).alias("fixed"))), 256)
    return catalogue.groupBy("service", "operation").agg(F.countDistinct(content).alias("variants")).filter("variants > 1")


def distinct_endpoints(catalogue: DataFrame) -> DataFrame:
    """One row per (service, operation); equal repeats collapse, different ones are an error when the plan runs."""
    whole = F.struct(*ENDPOINT, sorted_pairs(F.col("fixed_params")).alias("fixed"))
    grouped = catalogue.groupBy("service", "operation").agg(F.countDistinct(F.to_json(whole)).alias("variants"), F.any_value(F.struct(*ENDPOINT, "fixed_params")).alias("e"))
    checked = F.when(F.col("variants") > 1, F.raise_error(F.concat(F.lit("conflicting endpoint "), "service", F.lit("/"), "operation"))).otherwise(F.col("e"))
    return grouped.select(checked.alias("e")).select("e.*")


def select_operations(catalogue: DataFrame, wanted: list[str] | None) -> DataFrame:
    """The endpoints of the wanted operations; None means all, an empty list or an unknown name is an error."""
    if wanted is None:
        return catalogue
    if not wanted:
        raise ValueError("no operation was selected")
    spark = catalogue.sparkSession
    asked = spark.createDataFrame([(w,) for w in sorted(set(wanted))], "operation string")
    unknown = [r.operation for r in asked.join(catalogue, "operation", "left_anti").collect()]
    if unknown:
        raise ValueError(f"unknown operations: {unknown}")
    return catalogue.join(asked, "operation", "left_semi")


def missing_years(years: DataFrame, schools: DataFrame) -> DataFrame:
    """Requested years without a list of schools."""
    return years.select("svyYr").distinct().join(schools.select("svyYr").distinct(), "svyYr", "left_anti")


def parameter_clashes(catalogue: DataFrame) -> DataFrame:
    """Endpoints whose fixed parameters repeat a parameter of their strategy or hold a key that is secret."""
    scope = F.create_map(*(x for s, p in STRATEGIES.items() for x in (F.lit(s), F.array(*map(F.lit, p)).cast("array<string>"))))
    keys = F.coalesce(F.map_keys("fixed_params"), F.array().cast("array<string>"))
    clash = F.array_intersect(keys, F.coalesce(F.try_element_at(scope, F.col("scope_strategy")), F.array().cast("array<string>")))
    secret = F.filter(keys, lambda k: normalized_key(k).isin(*SECRETS))
    return catalogue.select("service", "operation", F.array_sort(F.array_union(clash, secret)).alias("clashes")).filter(F.size("clashes") > 0)


def _once(catalogue: DataFrame) -> DataFrame:
    """The different rows of a catalogue, with ``fixed_params`` never null."""
    pairs = sorted_pairs(F.col("fixed_params")).alias("pairs")
    known = catalogue.filter(F.col("scope_strategy").isin(*STRATEGIES)).select(*ENDPOINT, pairs).distinct()
    return known.select(*ENDPOINT, F.map_from_entries(F.transform("pairs", lambda p: F.struct(p[0], p[1]))).alias("fixed_params"))


def expand(catalogue: DataFrame, years: DataFrame, schools: DataFrame, divisions: DataFrame, prefix: str = "task-", salts: int = SALTS, small_rows: int = SMALL_ROWS) -> DataFrame:
    """The tasks of all endpoints, each once. ``years`` has ``svyYr``; ``schools`` ``svyYr, schlId``; ``divisions`` ``schlDivCd``.

    A fixed parameter that clashes with one of the strategy is an error when the plan runs. Schools
    of years that were not requested are not expanded; unknown strategies give no tasks.
    """
    text = F.lit(None).cast("string")
    by_year = years.select("svyYr").distinct()
    by_school = schools.select("svyYr", "schlId").distinct().join(by_year, "svyYr", "left_semi")
    values = {"schlId": text, "svyYr": text, "schlDivCd": text}

    def serving(dimension: DataFrame, *names: str) -> DataFrame:
        served = [s for s, own in STRATEGIES.items() if set(own) == set(names)]
        columns = [(F.col(n) if n in names else v).alias(n) for n, v in values.items()]
        return dimension.select(F.explode(F.array(*map(F.lit, served))).alias("scope_strategy"), *columns)

    nothing = catalogue.sparkSession.range(1)
    dimensions = (
        serving(by_school, "schlId", "svyYr")
        .unionByName(serving(by_year, "svyYr"))
        .unionByName(serving(divisions.select("schlDivCd").distinct(), "schlDivCd"))
        .unionByName(serving(nothing))
    )
    endpoints = _once(catalogue)
    if endpoints.limit(small_rows + 1).count() <= small_rows:
        joined = dimensions.join(F.broadcast(endpoints), "scope_strategy")
    else:
        spread = endpoints.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = dimensions.withColumn("salt", F.pmod(F.xxhash64(*values), F.lit(salts)).cast("int")).join(spread, ["scope_strategy", "salt"])
    own = F.create_map().cast("map<string,string>")
    for strategy, names in STRATEGIES.items():
        if names:
            own = F.when(F.col("scope_strategy") == strategy, F.create_map(*(x for n in names for x in (F.lit(n), F.col(n))))).otherwise(own)
    grid = joined.withColumn("own", own)
    clash = F.arrays_overlap(F.map_keys("fixed_params"), F.map_keys("own"))
    merged = F.when(clash, F.raise_error(F.lit("fixed and scope parameters conflict"))).otherwise(F.map_concat("fixed_params", "own"))
    return grid.select(*ENDPOINT, merged.alias("params")).select(task_id(prefix).alias("task_id"), *ENDPOINT, "params")


def task_id(prefix: str) -> Column:
    """The id of a task: a digest of its endpoint and its sorted parameters."""
    return content_id(prefix, params=sorted_pairs(F.col("params")), **{n: F.col(n) for n in ENDPOINT})


def in_order(tasks: DataFrame) -> DataFrame:
    """Tasks in the order in which they are run."""
    return tasks.orderBy("service", "operation", sorted_pairs(F.col("params")), "endpoint_url", "task_id")


def plan_summary(tasks: DataFrame) -> DataFrame:
    """Tasks, operations, services and years of a plan."""
    year = F.try_element_at("params", F.lit("svyYr"))
    return tasks.agg(
        F.count("*").alias("planned"), F.countDistinct("service", "operation").alias("operations"), F.countDistinct("service").alias("services"), F.array_join(F.array_sort(F.collect_set(year)), ",").alias("years")
    )


def request_params(strategy: Column, year: Column, school: Column, division: Column, fixed: Column, page: int = 1, size: int = 1) -> Column:
    """The parameters of a representative request, by strategy, with those of paging."""
    paging = F.create_map(F.lit("pageNo"), F.lit(str(page)), F.lit("numOfRows"), F.lit(str(size)))
    own = (
        F.when(strategy == "per_school_by_year", F.create_map(F.lit("svyYr"), year, F.lit("schlId"), school))
        .when(strategy.isin("nationwide_by_year", "lookup_by_year"), F.create_map(F.lit("svyYr"), year))
        .when(strategy == "regional_by_school_type", F.create_map(F.lit("schlDivCd"), division))
        .otherwise(F.create_map().cast("map<string,string>"))
    )
    return F.map_concat(paging, F.coalesce(fixed, F.create_map().cast("map<string,string>")), own)
