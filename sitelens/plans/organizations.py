"""Enhanced organizations: country scope, canonical places, investor flag, domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.domains import root_domain, standardize_domain
from sitelens.functions.geo import canonical_city, canonical_region
from sitelens.schemas import ORGANIZATIONS_ENHANCED, enforce

# Fixed value: the countries in scope.
NORDIC_COUNTRIES = ("DNK", "SWE", "NOR", "FIN", "ISL")


def investor_flag(roles) -> Column:
    """True when the role list mentions 'investor' (any case); NULL roles -> false."""
    roles = F.col(roles) if isinstance(roles, str) else roles
    return F.coalesce(F.lower(roles).contains("investor"), F.lit(False))


def in_countries(df: DataFrame, countries: Sequence[str] = NORDIC_COUNTRIES) -> DataFrame:
    return df.filter(F.col("organization_country_code").isin(*countries))


def organizations_enhanced(stg_orgs: DataFrame, countries: Sequence[str] = NORDIC_COUNTRIES) -> DataFrame:
    out = in_countries(stg_orgs, countries).withColumns({
        "standardized_city": canonical_city("organization_city"),
        "standardized_region": canonical_region("organization_region"),
        "is_investor": investor_flag("organization_roles"),
        "standardized_domain": standardize_domain("organization_domain"),
        "root_domain": root_domain("organization_domain"),
        "_enhanced_at": F.current_timestamp(),
    })
    return enforce(out, ORGANIZATIONS_ENHANCED)
