"""Model graph: raw sources -> staging -> intermediate -> marts.

``build_models`` returns lazy DataFrames for every model (what a query
needs is planned together, so Catalyst prunes and pushes down across
layers). ``run_pipeline`` materializes the layers the way the source project
does (intermediate tables and marts written; traffic upserted month by
month) below a shared output folder.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators.domain_match import DEFAULT_BROADCAST_BYTES, MATCH_KEY, match_key, repeated_keys
from sitelens.operators.skew import ByKey, write_by_key
from sitelens.operators.tables import remove_table
from sitelens.plans.bridge import (
    company_traffic, company_traffic_rows, company_web_bridge, keyed_organizations, matchable_traffic, matched_by_key, matched_traffic,
)
from sitelens.plans.category import category_insights_by_domain, domain_categories
from sitelens.plans.company import company_performance_by_domain
from sitelens.plans.organizations import organizations_enhanced
from sitelens.plans.staging import stg_organizations, stg_traffic
from sitelens.plans.timeseries import company_timeseries_by_domain
from sitelens.plans.traffic import traffic_enhanced
from sitelens.session import materialize, scale_conf, shared_table_path, write_table
from sitelens.sources.adapter import load_sources


#: Passes over traffic of which keys repeat, each of at least so many repeated keys.
PASSES, PASS_KEYS = 8, 250_000


class Models:
    """Every model as a lazily built DataFrame; a model (and the models it reads)
    is planned only when first asked for, so a query runs only its own lineage.

    With ``materialize_tables`` the table-materialized layers (enhanced
    organizations, enhanced traffic, the matched traffic rows and the wide
    company x traffic bridge rows) are written once to the shared checkpoint
    folder on first use and read back, as the source project builds them as
    tables; marts then start from file scans instead of re-running the layers
    below.

    The three marts read ``matched_traffic`` (traffic rows whose domain
    matches a company, each row once) and attach companies after
    aggregating per domain, so they never form company x traffic pairs; only
    the bridge model, whose rows are those pairs, does. ``unique_traffic``
    says that ``web_traffic_id`` is known to be unique, which saves a count.

    With ``buckets`` the matchable traffic is stored once in that many buckets of
    the match key (``operators.skew``): neither the domain match nor the marts'
    aggregates exchange traffic rows then."""

    def __init__(self, raw_orgs: DataFrame, raw_traffic: DataFrame,
                 broadcast_budget: int = DEFAULT_BROADCAST_BYTES, traffic: DataFrame | None = None,
                 materialize_tables: bool = False, organizations: DataFrame | None = None, unique_traffic: bool = False,
                 buckets: int | None = None):
        self._raw_orgs, self._raw_traffic = raw_orgs, raw_traffic
        self._unique_traffic, self._buckets = unique_traffic, buckets
        self._budget = broadcast_budget
        self._traffic, self._organizations = traffic, organizations
        self._materialize = materialize_tables
        self.scratch: list[str] = []  # folders of the layers written so far

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        if not self._materialize:
            return df
        path = write_table(df, name)
        self.scratch.append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _table_of_parts(self, parts: list[DataFrame], name: str) -> DataFrame:
        """A table written part by part, so that one part's shuffle is on disk at a time."""
        if not self._materialize:
            return reduce(DataFrame.unionByName, parts)
        path = write_table(parts[0], name)
        self.scratch.append(path)
        for part in parts[1:]:
            write_table(part, name, add_to=path)
        return parts[0].sparkSession.read.schema(parts[0].schema).parquet(path)

    def remove_scratch(self) -> None:
        """Remove the layers written so far; tables built from them stay."""
        if "traffic_by_domain" in self.__dict__:
            self.traffic_by_domain.forget()
        for path in self.scratch:
            remove_table(self._raw_traffic.sparkSession, path)

    def table(self, name: str) -> DataFrame:
        """Model ``name`` as a written table (the state tests run against, after a
        build); written once per ``Models``, lazy models stay as they are."""
        if not self._materialize:
            return getattr(self, name)
        cache = self.__dict__.setdefault("_tables", {})
        if name not in cache:
            df = getattr(self, name)
            cache[name] = df if name in ("organizations_enhanced", "traffic_enhanced") else self._table(df, name)
        return cache[name]

    @cached_property
    def stg_organizations(self) -> DataFrame:
        return stg_organizations(self._raw_orgs)

    @cached_property
    def stg_traffic(self) -> DataFrame:
        return stg_traffic(self._raw_traffic)

    @cached_property
    def organizations_enhanced(self) -> DataFrame:
        if self._organizations is not None:
            return self._organizations
        return self._table(organizations_enhanced(self.stg_organizations), "organizations_enhanced")

    @cached_property
    def traffic_enhanced(self) -> DataFrame:
        if self._traffic is not None:
            return self._traffic
        return self._table(traffic_enhanced(self.stg_traffic), "traffic_enhanced")

    @cached_property
    def repeated_traffic(self) -> DataFrame | None:
        """The values of ``web_traffic_id`` that several traffic rows have (the marts
        join traffic by this key, see the bridge); None if the key is unique."""
        if self._unique_traffic:
            return None
        found = self._table(repeated_keys(self.traffic_enhanced, "web_traffic_id"), "repeated_traffic")
        return None if found.isEmpty() else found

    @cached_property
    def company_traffic(self) -> DataFrame:
        if self.repeated_traffic is not None:
            rows = company_traffic_rows(self.keyed_organizations, self.matched_traffic, self._budget)
        else:
            rows = company_traffic(self.organizations_enhanced, self.traffic_enhanced, self._budget)
        return self._table(rows, "company_traffic")

    @cached_property
    def keyed_organizations(self) -> DataFrame:
        return keyed_organizations(self.organizations_enhanced)

    @cached_property
    def traffic_by_domain(self) -> ByKey:
        """Matchable traffic stored by match key."""
        keyed = matchable_traffic(self.traffic_enhanced).withColumn(MATCH_KEY, match_key("cleaned_site_domain"))
        path = shared_table_path(keyed.sparkSession, "traffic_by_domain")
        self.scratch.append(path)
        return write_by_key(keyed, MATCH_KEY, self._buckets, path)

    @cached_property
    def matched_traffic(self) -> DataFrame | ByKey:
        if self._buckets and self.repeated_traffic is None:
            return matched_by_key(self.keyed_organizations, self.traffic_by_domain, self._budget)
        traffic, repeated = self.traffic_enhanced, self.repeated_traffic
        passes = 1 if repeated is None or not self._materialize else max(1, min(PASSES, -(-repeated.count() // PASS_KEYS)))

        def part(rows: DataFrame, i: int) -> DataFrame:
            return rows if passes == 1 else rows.filter(F.pmod(F.xxhash64("web_traffic_id"), F.lit(passes)) == i)

        # Rows meet others of their key only, so the keys are dealt to the passes.
        parts = [matched_traffic(self.keyed_organizations, part(traffic, i), self._budget, None if repeated is None else part(repeated, i))
                 for i in range(passes)]
        return self._table_of_parts(parts, "matched_traffic")

    @cached_property
    def company_web_bridge(self) -> DataFrame:
        """Planned from the enhanced tables, so only its own columns pass the join."""
        return company_web_bridge(self.organizations_enhanced, self.traffic_enhanced, self._budget)

    @cached_property
    def mart_company_performance(self) -> DataFrame:
        return company_performance_by_domain(self.keyed_organizations, self.matched_traffic)

    @cached_property
    def mart_company_timeseries(self) -> DataFrame:
        return company_timeseries_by_domain(self.keyed_organizations, self.matched_traffic)

    @cached_property
    def domain_categories(self) -> DataFrame:
        """Matched traffic per (match key, category): what the category mart reads four times."""
        return self._table(domain_categories(self.matched_traffic), "domain_categories")

    @cached_property
    def mart_category_insights(self) -> DataFrame:
        return category_insights_by_domain(self.keyed_organizations, self.domain_categories)


def build_models(raw_orgs: DataFrame, raw_traffic: DataFrame,
                 broadcast_budget: int = DEFAULT_BROADCAST_BYTES,
                 traffic: DataFrame | None = None, materialize_tables: bool = False,
                 organizations: DataFrame | None = None, unique_traffic: bool = False,
                 buckets: int | None = None) -> Models:
    """All models over the given raw inputs. ``traffic`` may be an already
    materialized enhanced-traffic table (the incremental target), and
    ``organizations`` the enhanced organizations."""
    return Models(raw_orgs, raw_traffic, broadcast_budget, traffic, materialize_tables, organizations, unique_traffic, buckets)


_BUILDS: dict[tuple[str, str, bool], Models] = {}


def models_for(spark: SparkSession, sf_dir: str, by_country: bool = False) -> Models:
    """The models over the test tables in ``sf_dir``: one build per application,
    table layers materialized once and shared by every query. ``by_country``: over
    traffic of which some sites have a row for each of two countries."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), by_country)
    if key not in _BUILDS:
        raw_orgs, raw_traffic = load_sources(spark, sf_dir, by_country)
        _BUILDS[key] = build_models(raw_orgs, raw_traffic, materialize_tables=True)
    return _BUILDS[key]


def lazy_models_for(spark: SparkSession, sf_dir: str) -> Models:
    """Models planned end to end from the raw inputs, nothing materialized."""
    raw_orgs, raw_traffic = load_sources(spark, sf_dir)
    return build_models(raw_orgs, raw_traffic)


# Materialized models and where they go below the output folder.
TABLE_MODELS = ["organizations_enhanced", "company_web_bridge", "mart_company_performance",
                "mart_company_timeseries", "mart_category_insights"]


def run_pipeline(spark: SparkSession, organizations_source: str, traffic_source: str, out_dir: str,
                 run_checks: bool = True, fail_on_error: bool = False, input_bytes: int | None = None,
                 strict: bool = False, lookback_months: int = 0, full_refresh: bool = False,
                 buckets: int | None = None) -> DataFrame | None:
    """Full build (the project's ``run`` + ``test``).

    Staging models stay views (lazy). Enhanced traffic is loaded
    incrementally into ``out_dir/traffic_enhanced`` (month-partitioned; only
    months after its high-water mark are processed, or all with
    ``full_refresh``); rows that came too late are written to
    ``out_dir/late_traffic``. Every other table model is rebuilt from the
    enhanced tables, written once to a new folder and then put in the place of
    ``out_dir/<model>``, so readers keep the former table until the new one is
    complete. Scratch layers are removed at the end.
    Returns the check results (one row per declared check) when ``run_checks``.
    ``input_bytes`` (size of the traffic input) sizes shuffles and file splits;
    ``buckets`` stores the matchable traffic by domain first (see ``Models``).
    """
    from sitelens.operators.tables import replace_table
    from sitelens.operators.quality import ROW_KINDS, WatchedChecks, raise_on_errors, run_suite
    from sitelens.plans.checks import SUITE
    from sitelens.sources.raw import read_organizations, read_traffic
    from sitelens.streaming.incremental import known_unique, load_checked, load_increment

    if input_bytes:
        scale_conf(spark, input_bytes)
    out = out_dir.rstrip("/")
    raw_orgs = read_organizations(spark, organizations_source)
    raw_traffic = read_traffic(spark, traffic_source)
    traffic_path = f"{out}/traffic_enhanced"
    options = {"strict": strict, "lookback_months": lookback_months, "full_refresh": full_refresh}
    watched = {name: WatchedChecks(name, SUITE[name]) for name in ["traffic_enhanced", *TABLE_MODELS]}
    counts: dict[str, list[int]] = {}
    if run_checks:
        done, counts["traffic_enhanced"] = load_checked(spark, raw_traffic, traffic_path, watched["traffic_enhanced"], **options)
    else:
        done = load_increment(spark, raw_traffic, traffic_path, **options)
    if done.late is not None:
        replace_table(done.late, f"{out}/late_traffic")
    written = {"traffic_enhanced": spark.read.parquet(traffic_path)}

    def write(name: str, rows: DataFrame) -> DataFrame:
        replace_table(watched[name].attach(rows) if run_checks else rows, f"{out}/{name}")
        if run_checks:
            counts[name] = watched[name].counts()
        written[name] = spark.read.parquet(f"{out}/{name}")
        return written[name]

    companies = write("organizations_enhanced", organizations_enhanced(stg_organizations(raw_orgs)))
    models = build_models(raw_orgs, raw_traffic, traffic=written["traffic_enhanced"], materialize_tables=True, organizations=companies,
                          unique_traffic=known_unique(spark, traffic_path), buckets=buckets)
    for name in TABLE_MODELS[1:]:
        write(name, getattr(models, name))
    models.remove_scratch()
    if not run_checks:
        return None
    # Row checks of the tables came with their writes; what is left are keys, and the checks of sources and views.
    views = {"organization_summary": raw_orgs, "global_growth": raw_traffic,
             "stg_organizations": models.stg_organizations, "stg_traffic": models.stg_traffic}
    left = {name: [c for c in checks if name in views or c.kind not in ROW_KINDS] for name, checks in SUITE.items()}
    parts = [run_suite(views | written, left), *(watched[name].results(spark, n) for name, n in counts.items())]
    results = materialize(reduce(DataFrame.unionByName, parts), "check_results")
    return raise_on_errors(results) if fail_on_error else results
