"""Company <-> traffic bridge (J1, F7-F10, N10) and the join back to traffic.

``company_traffic`` joins the filtered companies to the *wide* enhanced
traffic rows once. While ``web_traffic_id`` is unique this also is what the
source rules' separate join of bridge and traffic on that key gives, and the
marts read it (or ``matched_traffic``, its per-domain form) directly.

Where several rows have one ``web_traffic_id`` (a site in several countries in
one month), the join back multiplies: each of the n bridge rows of a company
and key meets every traffic row of the key. ``matched_traffic`` then gives
each such row once for each domain, with n as its weight, and the marts
count it n times; ``company_traffic_rows`` writes the rows out.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.keys import surrogate_key
from sitelens.operators.domain_match import (
    DEFAULT_BROADCAST_BYTES, MATCH_KEY, SPREAD_BY, WEIGHT, domain_join, fits_broadcast, keep_matching, keep_matching_by_key, match_key,
)
from sitelens.operators.lookup import without_listed
from sitelens.operators.skew import ByKey
from sitelens.schemas import COMPANY_WEB_BRIDGE, enforce

# Domains that never identify a business, and match metadata.
NON_BUSINESS_DOMAINS = ("linkedin.com", "facebook.com", "twitter.com", "gmail.com", "yahoo.com", "hotmail.com")
EXACT_MATCH_CONFIDENCE = 0.95
EXACT_MATCH_METHOD = "exact_domain_match"

ORG_COLUMNS = ["organization_id", "organization_name", "organization_permalink", "standardized_domain",
               "standardized_city", "standardized_region", "organization_country_code", "is_investor",
               "organization_created_at", "organization_updated_at"]


def matchable_organizations(orgs: DataFrame, blocked: DataFrame | None = None,
                            broadcast_budget: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Companies with a domain of their own. ``blocked``: the domains that identify no
    business as a table (one column, lower case), instead of the short fixed list."""
    d = F.col("standardized_domain")
    named = orgs.select(*ORG_COLUMNS).filter(d.isNotNull() & (F.trim(d) != ""))
    if blocked is None:
        return named.filter(~F.lower(F.trim(d)).isin(*NON_BUSINESS_DOMAINS))
    return without_listed(named, match_key(d), blocked, ["organization_id"], broadcast_budget)


def matchable_traffic(traffic: DataFrame) -> DataFrame:
    c = F.col("cleaned_site_domain")
    return traffic.filter(c.isNotNull() & (F.trim(c) != "") & (F.col("total_visits") > 0))


def company_traffic(orgs: DataFrame, traffic: DataFrame,
                    broadcast_budget: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """One row per (company, matching traffic row): company columns + all traffic columns."""
    joined = domain_join(matchable_organizations(orgs), "standardized_domain",
                         matchable_traffic(traffic).drop("standardized_domain", "root_domain", "_enhanced_at"),
                         "cleaned_site_domain", broadcast_budget)
    return _assessed(joined.withColumnRenamed("standardized_domain", "organization_domain"))


def _assessed(joined: DataFrame) -> DataFrame:
    return joined.withColumns({
        "match_confidence_score": F.lit(EXACT_MATCH_CONFIDENCE).cast("double"),
        "match_method": F.lit(EXACT_MATCH_METHOD),
        "is_domain_match": F.lit(True),
    })


def company_traffic_rows(keyed_orgs: DataFrame, matched: DataFrame,
                         broadcast_budget: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``company_traffic`` from weighted ``matched_traffic``: a row for each
    (bridge row, traffic row) pair of the join back on ``web_traffic_id``."""
    companies = keyed_orgs.drop("match_confidence_score")
    if fits_broadcast(companies, broadcast_budget):
        companies = F.broadcast(companies)
    rows = matched.drop("standardized_domain", "root_domain", "_enhanced_at").join(companies, MATCH_KEY).drop(MATCH_KEY)
    return _assessed(rows.withColumn(WEIGHT, F.explode(F.sequence(F.lit(1).cast("long"), WEIGHT))).drop(WEIGHT))


def bridge_from(company_rows: DataFrame) -> DataFrame:
    out = company_rows.select(
        surrogate_key("organization_id", "web_traffic_id").alias("company_web_bridge_id"),
        "*",
        F.col("cleaned_site_domain").alias("traffic_domain"),
        F.col("site_country").alias("traffic_country"),
        F.current_timestamp().alias("_bridged_at"),
    ).filter(F.col("is_domain_match") & (F.col("match_confidence_score") > 0))
    return enforce(out, COMPANY_WEB_BRIDGE)


def company_web_bridge(orgs: DataFrame, traffic: DataFrame,
                       broadcast_budget: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return bridge_from(company_traffic(orgs, traffic, broadcast_budget))


def keyed_organizations(orgs: DataFrame) -> DataFrame:
    """Matchable companies with their match key and the bridge's company columns."""
    return (matchable_organizations(orgs)
            .withColumn(MATCH_KEY, match_key("standardized_domain"))
            .withColumnRenamed("standardized_domain", "organization_domain")
            .withColumn("match_confidence_score", F.lit(EXACT_MATCH_CONFIDENCE).cast("double")))


def matched_traffic(keyed_orgs: DataFrame, traffic: DataFrame, broadcast_budget: int = DEFAULT_BROADCAST_BYTES,
                    repeated: DataFrame | None = None) -> DataFrame:
    """Traffic rows that match at least one company, each once, with the match key.
    ``repeated``: the values of ``web_traffic_id`` that several rows have, if any;
    the rows then carry a weight (see the module)."""
    if repeated is None:
        return keep_matching(matchable_traffic(traffic), "cleaned_site_domain", keyed_orgs, broadcast_budget)
    return keep_matching_by_key(traffic, matchable_traffic(traffic), "cleaned_site_domain", "web_traffic_id", repeated,
                                keyed_orgs, broadcast_budget)


def matched_by_key(keyed_orgs: DataFrame, stored: ByKey, broadcast_budget: int = DEFAULT_BROADCAST_BYTES) -> ByKey:
    """``matched_traffic`` over traffic stored by match key: the semi join keeps the
    buckets, only company keys are exchanged or (within the budget) broadcast."""
    keys = keyed_orgs.select(MATCH_KEY).distinct()
    if fits_broadcast(keys, broadcast_budget):
        return replace(stored, cold=stored.cold.join(F.broadcast(keys), MATCH_KEY, "left_semi"),
                       hot=stored.hot.join(F.broadcast(keys), MATCH_KEY, "left_semi"))
    return stored.joined(keys, SPREAD_BY, "left_semi")


def bridge_by_key(orgs: DataFrame, stored: ByKey) -> DataFrame:
    """The bridge over traffic stored by match key, without exchange of the bucketed rows."""
    companies = matchable_organizations(orgs).withColumn(MATCH_KEY, match_key("standardized_domain"))
    cold, hot = (part.drop("standardized_domain", "root_domain", "_enhanced_at") for part in (stored.cold, stored.hot))
    joined = replace(stored, cold=cold, hot=hot).joined(companies, SPREAD_BY).rows().drop(MATCH_KEY)
    return bridge_from(_assessed(joined.withColumnRenamed("standardized_domain", "organization_domain")))
