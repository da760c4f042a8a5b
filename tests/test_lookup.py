"""Lists and dictionaries as tables: broadcast, and beyond the budget."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens.functions.geo import CITY_VARIANTS, canonical_city
from sitelens.operators import lookup
from sitelens.operators.lookup import AmbiguousVariant, bit_table, canonical_by_table, without_listed
from sitelens.plans.bridge import NON_BUSINESS_DOMAINS, matchable_organizations
from sitelens.plans.pipeline import lazy_models_for


def rows(df):
    return sorted(map(str, df.collect()))


def table(spark, n=20_000):
    i = F.col("id")
    name = F.when(i % 3 == 0, "hot.com").when(i % 11 == 1, F.lit(None)).otherwise(F.concat(F.lit("site"), (i % 7001).cast("string"), F.lit(".com")))
    return spark.range(n).select("id", name.alias("name"))


@pytest.mark.parametrize("budget,bits", [(256 << 20, 16), (0, 16), (0, 1), (-(1 << 20), 1 << 30)])
def test_without_listed_equals_a_plain_anti_join(spark, monkeypatch, budget, bits):
    monkeypatch.setattr(lookup, "BITS_A_VALUE", bits)  # fewer bits: more rows to verify, the same result
    df = table(spark)
    listed = spark.range(4000).select(F.concat(F.lit("site"), (F.col("id") * 2).cast("string"), F.lit(".com"))).union(
        spark.createDataFrame([("hot.com",), (None,), ("site4.com",)], "x string"))
    want = df.join(listed.toDF("name").distinct(), "name", "left_anti").select("id", "name")
    got = without_listed(df, F.col("name"), listed, ["id"], budget)
    assert got.columns == df.columns and rows(got) == rows(want) and want.count() < df.count()


def test_an_empty_list(spark):
    df = table(spark, 100)
    assert without_listed(df, F.col("name"), spark.createDataFrame([], "x string"), ["id"], -1).count() == 100


def test_bits(spark):
    values = spark.range(5000).select(F.col("id").cast("string").alias("_listed_value"))
    bits = 80_000
    held = bit_table(values, bits)
    asked = (spark.range(20_000).select(F.col("id").cast("string").alias("_listed_value"))
             .withColumn("_bit", lookup._bit_of("_listed_value", bits)).withColumn("_bit_row", F.floor(F.col("_bit") / 32768).cast("long"))
             .join(held, "_bit_row", "left").withColumn("maybe", lookup._is_set(F.col("_bit") % 32768)))
    n = {r["listed"]: r["maybe"] for r in asked.groupBy((F.col("_listed_value").cast("int") < 5000).alias("listed")).agg(
        F.avg(F.col("maybe").cast("int")).alias("maybe")).collect()}
    assert n[True] == 1.0 and n[False] < 0.12


def test_only_suspects_are_shuffled(spark):
    df = table(spark)
    listed = spark.createDataFrame([("site4.com",)], "x string")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        text = without_listed(df, F.col("name"), listed, ["id"], 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    clean, suspects = text.split("\n+- ")  # the branches of the union
    assert "Exchange hashpartitioning" not in clean and "Exchange hashpartitioning" in suspects and "LeftAnti" in suspects


def test_block_list_of_companies(spark):
    orgs = lazy_models_for(spark, SF_SMALL).organizations_enhanced
    listed = spark.createDataFrame([(d,) for d in NON_BUSINESS_DOMAINS], "d string")
    for budget in (256 << 20, 0):
        assert rows(matchable_organizations(orgs, listed, budget)) == rows(matchable_organizations(orgs))
    every = matchable_organizations(orgs)
    one = every.first()["standardized_domain"]
    blocked = matchable_organizations(orgs, spark.createDataFrame([(one.strip().lower(),)], "d string"), 0)
    assert rows(blocked) == rows(every.filter(F.lower(F.trim("standardized_domain")) != one.strip().lower())) and blocked.count() < every.count()


@pytest.mark.parametrize("budget", [256 << 20, 0])
def test_canonical_names_by_table(spark, budget):
    variants = spark.createDataFrame([(v.upper() if i % 2 else v, c) for c, vs in CITY_VARIANTS.items() for i, v in enumerate(vs)] + [(None, "x"), ("cph", "Copenhagen")],
                                     "variant string, canonical string")
    names = ["KØBENHAVN", "Cph", "århus", "Aarhus", "Stockholm", None, "", "koge"] + ["copenhagen"] * 40
    df = spark.createDataFrame(list(enumerate(names)), "id int, city string")
    got = canonical_by_table(df, "city", "name", variants, ["id"], budget)
    assert rows(got.select("id", "city", "name")) == rows(df.select("id", "city", canonical_city("city").alias("name")))
    with pytest.raises(AmbiguousVariant):
        canonical_by_table(df, "city", "name", variants.union(spark.createDataFrame([("CPH", "Elsewhere")], "a string, b string")), ["id"])
