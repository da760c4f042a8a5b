"""Derive the two raw inputs (company directory, monthly site traffic) from the
driver's TPC-H-like test tables.

The test data has no companies or web traffic, so both raw tables are
computed from ``lineitem`` and ``supplier`` by fixed rules; they grow with the
test tables. All work is declarative Spark: one aggregation of ``lineitem``
(hot suppliers are split across tasks) and four size-safe ranks in one pass.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitelens.functions.metrics import safe_div
from sitelens.operators.ranking import add_row_numbers
from sitelens.operators.skew import heavy_keys
from sitelens.operators.tables import data_files, read_if_exists, remove_table, replace_table
from sitelens.session import shared_root
from sitelens.schemas import CHANNELS, ORG_RAW, TRAFFIC_RAW

# Fixed values of the test-data rules.
CHANNEL_BY_PART_MOD7 = ["direct", "organic_search", "paid_search", "referrals", "social", "display", "mail"]
CITY_BY_NATION_MOD13 = ["Copenhagen", "KØBENHAVN", "cph", "Århus", "aarhus", "Odense", "Ålborg",
                        "Stockholm", "Oslo", "Helsinki", "Reykjavík", "Koge", None]
REGION_BY_NATION_MOD7 = ["Hovedstaden", "Region Midtjylland", "nordjylland", "Syddanmark", "sjaelland",
                         "Uppsala", None]
COUNTRY_BY_NATION_MOD7 = ["DNK", "SWE", "NOR", "FIN", "ISL", "USA", "DEU"]
RANKS = [("global_rank", ["year", "month"]),
         ("country_rank", ["country", "year", "month"]),
         ("main_category_rank", ["main_category", "year", "month"]),
         ("category_rank", ["site_category", "year", "month"])]
CREATED_AT = _dt.datetime(2015, 1, 1)
UPDATED_AT = _dt.datetime(2020, 1, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list) -> Column:
    """``values[index]`` as a CASE expression (NULL entries stay NULL)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _site_months(lines: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Sums over the lines of each (supplier, shop, month, country), and how many
    orders they are of. Lines travel as they are and are added up where they arrive;
    the lines of an order are neighbours there, and the first one counts it (and
    the first of each device). ``parts``: into how many parts, by order, a
    supplier's lines are cut, whose sums are added."""
    at = ["k", "ym", "shop", "c"]
    dealt = ["k", "ym"]
    if parts is not None:
        lines = lines.join(F.broadcast(parts), "k").withColumn("part", F.pmod(F.xxhash64("o"), F.col("_parts"))).drop("_parts")
        at, dealt = [*at, "part"], [*dealt, "part"]
    k, ln, q, d, pr, o = (F.col(c) for c in ("k", "ln", "q", "d", "pr", "o"))
    of_order = Window.partitionBy(*at, "o").orderBy("mob")
    rows = lines.repartition(*dealt).withColumns({
        "shop": F.coalesce((k % 10 == 0) & (ln % 2 == 1), F.lit(False)),
        "mob": (ln + k) % 7 < k % 7,
    }).withColumns({"_new": F.row_number().over(of_order) == 1, "_last_mob": F.lag("mob").over(of_order)})
    mob, new = F.col("mob"), F.col("_new")
    new_device = new | ~F.col("mob").eqNullSafe(F.col("_last_mob"))
    sums = {"_n": F.lit(1), "_sum_q": q, "_sum_ln": ln, "_sum_d": d, "_sum_qln": q * ln}
    for dev, cond in (("desktop", ~mob), ("mobileweb", mob)):
        sums[f"_{dev}_q"] = F.when(cond, q)
        sums[f"_{dev}_qln"] = F.when(cond, q * ln)
        sums[f"_{dev}_d"] = F.when(cond, d)
        sums[f"_{dev}_n"] = F.when(cond, 1).otherwise(0)
        sums[f"{dev}_estimated_unique"] = F.when(cond & new_device, 1).otherwise(0)
    for i, ch in enumerate(CHANNEL_BY_PART_MOD7):
        sums[f"desktop_{ch}_estimated_visits"] = F.when(~mob & (pr % 7 == i), q).otherwise(0)
    for i in range(6):
        sums[f"_age{i}_q"] = F.when(pr % 6 == i, q).otherwise(0)
    sums |= {"deduplicated_audience": F.when(new, 1).otherwise(0),
             "_male_q": F.when(o % 2 == 0, q).otherwise(0), "_female_q": F.when(o % 2 == 1, q).otherwise(0)}
    found = rows.groupBy(*at).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    return found if parts is None else found.groupBy(*at[:-1]).agg(*[F.sum(n).alias(n) for n in sums])


def raw_traffic(lineitem: DataFrame, by_country: bool = False, scratch: list[str] | None = None) -> DataFrame:
    """Monthly traffic rows, grain = supplier x site x ship month (45 columns).
    ``by_country``: every third supplier's sites have two rows a month, one for
    each of two countries its orders are dealt to. ``scratch`` gets the folders
    written on the way, which the result reads."""
    k, o = F.col("l_suppkey"), F.col("l_orderkey")
    li = lineitem.select(
        k.alias("k"), o.alias("o"),
        (F.col("l_partkey") % 42).alias("pr"),  # channels go by its remainder of 7, ages of 6
        F.col("l_linenumber").alias("ln"),
        F.col("l_quantity").cast("long").alias("q"),
        F.round(F.col("l_discount") * 100).cast("long").alias("d"),
        (F.year("l_shipdate") * 16 + F.month("l_shipdate")).alias("ym"),
    ).withColumn("c", F.when(F.col("k") % 3 == 0, (F.col("k") + F.col("o") % 2) % 4).otherwise(F.col("k") % 4)
                 if by_country else F.col("k") % 4)

    # A supplier with more lines than a shuffle partition holds on average is dealt
    # out by order too, so even one with a third of all lines is spread over many tasks.
    share = 1 / max(1, int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    heavy = heavy_keys(li.select("k"), "k", share)
    g = _site_months(li if heavy.isEmpty() else li.join(F.broadcast(heavy), "k", "left_anti"))
    if not heavy.isEmpty():
        g = g.unionByName(_site_months(li, heavy))

    kk, sum_q, n = F.col("k"), F.col("_sum_q"), F.col("_n")
    sk = kk.cast("string")
    no_totals = kk % 11 == 0
    # What the ranks go by, and with the sums what all other columns are made of.
    ranked_by = {
        "site": F.when(F.col("shop"), F.concat(F.lit("https://www.supplier"), sk, F.lit(".example.com/shop")))
                 .otherwise(F.concat(F.lit("supplier"), sk, F.lit(".example.com"))),
        "site_category": F.concat(F.lit("cat-"), (kk % 6).cast("string"), F.lit("/sub-"), (kk % 3).cast("string")),
        "main_category": F.when(kk % 23 == 7, F.lit(None).cast("string"))
                          .otherwise(F.concat(F.lit("cat-"), (kk % 6).cast("string"))),
        "country": F.concat(F.lit("C"), F.col("c").cast("string")),
        "year": F.shiftright("ym", 4),
        "month": F.col("ym").bitwiseAND(F.lit(15)),
        "total_estimated_visits": F.when((kk % 19 == 3) & (F.col("ym").bitwiseAND(F.lit(15)) == 2), F.lit(0)).otherwise(sum_q).cast("long"),
    }
    # Ranks: (visits desc, site, country) is a total order inside every (.., year, month) group.
    order = [F.col("total_estimated_visits").desc(), F.col("site").asc(), F.col("country").asc()]
    ranked = add_row_numbers(g.withColumns(ranked_by).drop("ym", "shop", "c"), RANKS, order, scratch)

    cols = {
        "clean_site": F.when(kk % 17 == 5, F.lit(""))
                       .when(kk % 13 == 0, F.concat(F.lit(" Supplier"), sk, F.lit(".EXAMPLE.com ")))
                       .otherwise(F.concat(F.lit("supplier"), sk, F.lit(".example.com"))),
        "total_estimated_unique": F.when(no_totals, F.lit(None).cast("long"))
                                   .otherwise(F.floor(sum_q * (50 + kk % 50) / F.lit(100.0)).cast("long")),
        "total_estimated_pageviews": F.col("_sum_qln").cast("long"),
        "total_pages_per_visit": F.when(no_totals, F.lit(None).cast("double"))
                                  .otherwise(F.col("_sum_ln") * (1 + kk % 4) * F.lit(1.0) / (2 * n)),
        "total_visits_duration": F.when(no_totals, F.lit(None).cast("double"))
                                  .otherwise(sum_q * 3 * (1 + kk % 5) * F.lit(1.0) / n),
        "total_bounce_rate": F.when(no_totals, F.lit(1.5)).otherwise(F.col("_sum_d") / (n * F.lit(10.0))),
        "total_males_share": F.when(kk % 5 == 0, F.lit(0.5)).otherwise(safe_div(F.col("_male_q"), sum_q)),
        "total_females_share": F.when(kk % 5 == 0, F.lit(0.5)).otherwise(safe_div(F.col("_female_q"), sum_q)),
    }
    for dev in ("desktop", "mobileweb"):
        dq, dn = F.col(f"_{dev}_q"), F.col(f"_{dev}_n")
        cols[f"{dev}_estimated_visits"] = dq.cast("long")
        cols[f"{dev}_estimated_page_views"] = F.col(f"_{dev}_qln").cast("long")
        cols[f"{dev}_pages_per_visit"] = safe_div(F.col(f"_{dev}_qln"), dq)
        cols[f"{dev}_visits_duration"] = safe_div(dq * F.lit(10.0), dn)
        cols[f"{dev}_bounce_rate"] = safe_div(F.col(f"_{dev}_d"), dn * F.lit(10.0))
    for i, band in enumerate(["18_to_24", "25_to_34", "35_to_44", "45_to_54", "55_to_64", "65_plus"]):
        cols[f"total_ages_{band}_share"] = safe_div(F.col(f"_age{i}_q"), sum_q)
    return ranked.select(*[cols.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in TRAFFIC_RAW.fields])


def raw_organizations(supplier: DataFrame) -> DataFrame:
    """One company per supplier plus a second one for every fourth supplier."""
    s = supplier.select("s_suppkey", "s_name", "s_nationkey").withColumn(
        "_extra", F.explode(F.when(F.col("s_suppkey") % 4 == 0, F.array(F.lit(False), F.lit(True)))
                               .otherwise(F.array(F.lit(False)))))
    key, nation, extra = F.col("s_suppkey"), F.col("s_nationkey"), F.col("_extra")
    sk = key.cast("string")
    plain_domain = F.concat(F.lit("supplier"), sk, F.lit(".example.com"))
    domain = (F.when(key % 6 == 0, F.concat(F.lit("https://www.supplier"), sk, F.lit(".example.com/about")))
              .when(key % 6 == 1, plain_domain)
              .when(key % 6 == 2, F.concat(F.lit(" WWW.Supplier"), sk, F.lit(".example.com")))
              .when(key % 6 == 3, F.concat(F.lit("http://supplier"), sk, F.lit(".example.com")))
              .when(key % 6 == 4, F.concat(F.lit("www.supplier"), sk, F.lit(".example.com/")))
              .otherwise(F.when(key % 4 == 1, F.lit("linkedin.com"))))
    roles = F.when(key % 3 == 0, F.lit("company")).when(key % 3 == 1, F.lit("Investor,company"))
    null = F.lit(None).cast("string")

    def either(base: Column, extra_value: Column) -> Column:
        return F.when(extra, extra_value).otherwise(base)

    cols = {
        "uuid": either(F.concat(F.lit("org-"), sk), F.concat(F.lit("org-b-"), sk)),
        "name": either(F.col("s_name"), F.concat(F.col("s_name"), F.lit(" B"))),
        "type": F.lit("organization"),
        "permalink": either(F.lower("s_name"), F.concat(F.lower("s_name"), F.lit("-b"))),
        "roles": either(roles, F.lit("investor")),
        "domain": either(domain, plain_domain),
        "city": either(_pick(nation % 13, CITY_BY_NATION_MOD13), F.lit("Aarhus")),
        "region": either(_pick(nation % 7, REGION_BY_NATION_MOD7), F.lit("central jutland")),
        "country_code": either(_pick(nation % 7, COUNTRY_BY_NATION_MOD7), F.lit("DNK")),
        "created_at": F.lit(CREATED_AT).cast("timestamp_ntz"),
        "updated_at": F.lit(UPDATED_AT).cast("timestamp_ntz"),
    }
    return s.select(*[(cols.get(f.name, null)).cast(f.dataType).alias(f.name) for f in ORG_RAW.fields])


def derive_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(raw organizations, raw traffic) derived from the tables in ``sf_dir`` (lazy)."""
    return (raw_organizations(read_table(spark, sf_dir, "supplier")),
            raw_traffic(read_table(spark, sf_dir, "lineitem")))


_MATERIALIZED: dict[tuple[str, str, bool], tuple[str, str]] = {}


def _derivation_key(spark: SparkSession, sf_dir: str) -> str:
    """Identity of one derivation: path, length and modification time of every
    input file (a listing; no content is read) and the text of these rules."""
    files = [tuple(map(str, r)) for t in ("supplier", "lineitem") for r in data_files(spark, f"{sf_dir}/{t}.parquet").collect()]
    with open(__file__, "rb") as fh:
        rules = hashlib.sha1(fh.read()).hexdigest()
    return hashlib.sha1(f"{sf_dir}|{sorted(files)}|{rules}".encode()).hexdigest()[:20]


def load_sources(spark: SparkSession, sf_dir: str, by_country: bool = False) -> tuple[DataFrame, DataFrame]:
    """The derived raw tables, written to the shared checkpoint folder (like
    the source tables of a warehouse) and read back, so every query that
    starts from them scans parquet. A later application with the same input
    files and rules reuses a completed earlier derivation (a table appears
    under its name only when it is complete)."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, by_country)
    if key not in _MATERIALIZED:
        base = f"{shared_root(spark)}/derived/{_derivation_key(spark, sf_dir)}"
        orgs_path, traffic_path = f"{base}/raw_organizations", f"{base}/raw_traffic{'_by_country' if by_country else ''}"
        if read_if_exists(spark, orgs_path) is None:
            replace_table(raw_organizations(read_table(spark, sf_dir, "supplier")), orgs_path)
        if read_if_exists(spark, traffic_path) is None:
            scratch: list[str] = []
            replace_table(raw_traffic(read_table(spark, sf_dir, "lineitem"), by_country, scratch), traffic_path)
            for path in scratch:
                remove_table(spark, path)
        _MATERIALIZED[key] = (orgs_path, traffic_path)
    orgs_path, traffic_path = _MATERIALIZED[key]
    return (spark.read.schema(ORG_RAW).parquet(orgs_path),
            spark.read.schema(TRAFFIC_RAW).parquet(traffic_path))


assert set(CHANNEL_BY_PART_MOD7) == set(CHANNELS)
