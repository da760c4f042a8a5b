"""The company and time-series marts from monthly state (A2-A10).

The state has one row for each (match key, month) of the matchable traffic: sums,
counts of non-NULL values, label counts, least and greatest values, and the first
and last row. All of it merges, so the marts over all months come from state
rows, and a new or rewritten month is aggregated alone: ``update_state`` compares
the stamps that the traffic loader gives to the months it writes with those the
state was derived from, reads the months that differ (literal partition filters)
and replaces their partitions. A run that breaks off leaves older stamps, so
the next one derives those months again.

Where ``web_traffic_id`` repeats, a row's weight (see ``plans.bridge``) is known
within its month, for the key has the month in it. So many months go through in
several passes, each with its share of the rows, and what a pass exchanges is
gone before the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.periods import yyyymm
from sitelens.operators import manifest
from sitelens.operators.aggregates import label_counts, rows_of, total, traffic_row_order
from sitelens.operators.domain_match import DEFAULT_BROADCAST_BYTES, MATCH_KEY, WEIGHT, fits_broadcast, match_key, repeated_keys, weight_of
from sitelens.operators.tables import read_if_exists, remove_table
from sitelens.operators.upsert import in_months
from sitelens.plans import company, timeseries
from sitelens.plans.bridge import matchable_traffic
from sitelens.plans.traffic import LEADER_LABELS, PLATFORM_LABELS, QUALITY_LABELS
from sitelens.schemas import MART_TIMESERIES, enforce
from sitelens.session import dropping_shuffles, write_table

KEYS = [MATCH_KEY, "traffic_year", "traffic_month"]
LABELS = {"_qt": ("quality_tier", QUALITY_LABELS), "_pp": ("platform_preference", PLATFORM_LABELS),
          "_el": ("platform_engagement_leader", LEADER_LABELS)}
MEANS = ["overall_quality_score", "total_visits", *company.AVERAGED]
_LABEL_COLUMNS = [f"{prefix}{i}" for prefix, (_, labels) in LABELS.items() for i in range(len(labels))]
STAMPS_DIR = "_traffic_stamps"
_STAMPS_SCHEMA = "year int, month int, stamp string"


def _counted(c: str, weight: str | None) -> Column:
    return F.count(c) if weight is None else F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col(weight))), F.lit(0))


#: Passes over the months to derive, each with at least so many rows.
PASSES, PASS_ROWS = 8, 500_000


def weighted_by_key(traffic: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """Matchable traffic with its match key; with weights where ``web_traffic_id`` repeats
    (these values are written to a folder that ``scratch`` gets; without any, no row is joined)."""
    def keyed(rows: DataFrame) -> DataFrame:
        return matchable_traffic(rows).withColumn(MATCH_KEY, match_key("cleaned_site_domain"))

    found = repeated_keys(traffic, "web_traffic_id")
    path = write_table(found, "repeated_traffic")
    if scratch is not None:
        scratch.append(path)
    repeated = traffic.sparkSession.read.schema(found.schema).parquet(path)
    if repeated.isEmpty():
        return keyed(traffic).withColumn(WEIGHT, F.lit(1).cast("long"))
    partners = keyed(traffic).join(repeated, "web_traffic_id", "left_semi").groupBy("web_traffic_id", MATCH_KEY).agg(
        F.count(F.lit(1)).alias(WEIGHT))
    several = traffic.join(repeated, "web_traffic_id", "left_semi").join(partners, "web_traffic_id")
    single = keyed(traffic.join(repeated, "web_traffic_id", "left_anti")).withColumn(WEIGHT, F.lit(1).cast("long"))
    return single.unionByName(several.select(*single.columns))


def monthly_state(matched: DataFrame) -> DataFrame:
    """One row for each (match key, month) of traffic rows with match keys."""
    weight = weight_of(matched)
    order = traffic_row_order(weight)
    return matched.groupBy(*KEYS).agg(
        rows_of(weight).alias("_rows"),
        *[F.min(c).alias(f"_min_{c}") for c in company.RANKS],
        *[total(c, weight).alias(f"_sum_{c}") for c in company.SUMMED],
        *[total(F.col(c).cast("double"), weight).alias(f"_total_{c}") for c in MEANS],
        *[_counted(c, weight).alias(f"_count_{c}") for c in MEANS],
        *[n for prefix, (column, labels) in LABELS.items() for n in label_counts(column, labels, prefix, weight)],
        F.max("total_visits").alias("_max_total_visits"), F.max("overall_quality_score").alias("_max_overall_quality_score"),
        F.min(order).alias("_first_order"), F.max(order).alias("_last_order"),
        F.min_by(F.struct(*company.FIRST_ROW_TRAFFIC_ONLY), order).alias("_first_traffic"),
        F.min_by(F.struct(*timeseries.BOUNDARY_METRICS), order).alias("_first_vals"),
        F.max_by(F.struct(*timeseries.BOUNDARY_METRICS), order).alias("_last_vals"),
    )


def _mean(c: str) -> Column:
    return F.sum(f"_total_{c}") / F.nullif(F.sum(f"_count_{c}"), F.lit(0))


def _months() -> list[Column]:
    period = yyyymm("traffic_year", "traffic_month")
    return [F.min(period).alias("_first"), F.max(period).alias("_last"), F.count(F.lit(1)).alias("months_available")]


def _of_companies(keyed_orgs: DataFrame, state: DataFrame, budget: int) -> DataFrame:
    keys = keyed_orgs.select(MATCH_KEY).distinct()
    return state.join(F.broadcast(keys) if fits_broadcast(keys, budget) else keys, MATCH_KEY, "left_semi")


def company_performance_from_state(keyed_orgs: DataFrame, state: DataFrame, budget: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    per_key = _of_companies(keyed_orgs, state, budget).groupBy(MATCH_KEY).agg(
        *[F.min(f"_min_{c}").alias(c) for c in company.RANKS],
        *[F.sum(f"_sum_{c}").alias(c) for c in company.SUMMED],
        _mean("overall_quality_score").alias("digital_performance_score"),
        *[_mean(c).alias(c) for c in company.AVERAGED],
        *[F.sum(c).alias(c) for c in _LABEL_COLUMNS],
        F.min_by("_first_traffic", "_first_order").alias("_first_traffic"), *_months())
    companies = keyed_orgs.select("organization_id", *company.COMPANY_ATTRS, "match_confidence_score", MATCH_KEY)
    return company._finish(companies.join(per_key, MATCH_KEY, "inner"))


def company_timeseries_from_state(keyed_orgs: DataFrame, state: DataFrame, min_months: int = timeseries.MIN_MONTHS,
                                  budget: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    per_key = _of_companies(keyed_orgs, state, budget).groupBy(MATCH_KEY).agg(
        F.max("_max_total_visits").alias("peak_visits"), F.min("_min_site_global_rank").alias("best_global_rank"),
        F.max("_max_overall_quality_score").alias("peak_quality_score"),
        _mean("total_visits").alias("avg_visits"), _mean("overall_quality_score").alias("avg_quality_score"),
        *[F.sum(c).alias(c) for c in _LABEL_COLUMNS],
        F.min_by("_first_traffic", "_first_order").alias("_presence"),
        F.min_by("_first_vals", "_first_order").alias("_first_vals"), F.max_by("_last_vals", "_last_order").alias("_last_vals"),
        *_months()).filter(F.col("months_available") >= min_months)
    companies = keyed_orgs.select(*timeseries.GROUP_KEYS, "match_confidence_score", MATCH_KEY)
    boundaries = timeseries._boundary_columns(companies.join(per_key, MATCH_KEY, "inner"))
    return enforce(timeseries.add_growth(boundaries), MART_TIMESERIES)


def _passes(months: list[tuple[int, int]], rows: dict[tuple[int, int], int]) -> list[list[tuple[int, int]]]:
    """The months in runs of about an eighth of their rows, or of ``PASS_ROWS`` if that is more."""
    share = max(PASS_ROWS, -(-sum(rows.get(m, 0) for m in months) // PASSES))
    found: list[list[tuple[int, int]]] = []
    left = 0
    for m in months:
        if not found or left < rows.get(m, 0):
            found.append([])
            left = share
        found[-1].append(m)
        left -= rows.get(m, 0)
    return found


def update_state(spark: SparkSession, traffic_path: str, state_path: str) -> list[tuple[int, int]]:
    """Bring the state at ``state_path`` up to the traffic loaded at ``traffic_path``;
    the months derived anew are returned."""
    now = manifest.stamps(spark, traffic_path)
    notes = f"{state_path.rstrip('/')}/{STAMPS_DIR}"
    table = read_if_exists(spark, notes, _STAMPS_SCHEMA)
    then = {} if table is None else {(r["year"], r["month"]): r["stamp"] for r in table.collect()}
    traffic = spark.read.parquet(traffic_path)
    unknown = {tuple(r) for r in traffic.select("traffic_year", "traffic_month").distinct().collect()} - set(now)
    if unknown:
        raise ValueError(f"{traffic_path} has months that its loader has not recorded: {sorted(unknown)}")
    months = sorted(m for m, stamp in now.items() if then.get(m) != stamp)
    gone = set(then) - set(now)  # a refresh without them
    if gone:
        months = sorted(now)
    if months:
        mode = "static" if gone or not then else "dynamic"
        for some in _passes(months, {m: f.rows for m, f in manifest.recorded(spark, traffic_path).items()}):
            scratch: list[str] = []
            rows = monthly_state(weighted_by_key(traffic.filter(in_months(some)), scratch))
            with dropping_shuffles(spark):
                (rows.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd")
                 .partitionBy("traffic_year", "traffic_month").parquet(state_path))
            for path in scratch:
                remove_table(spark, path)
            mode = "dynamic"
        (spark.createDataFrame([(*m, s) for m, s in sorted(now.items())], _STAMPS_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(notes))
    return months
