"""The plans themselves: what is read, what is broadcast, what is shuffled, and where Python runs."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.bindings import all_queries, raw, routes
from skyledger.bindings.raw import spark_rows, table
from skyledger.functions import text
from skyledger.plans import dimensions, legs, markets, mart, years
from skyledger.sinks.tables import bucketed
from tests.conftest import SMALL

# archives are the only thing that needs Python in a task
PYTHON = {"archive_unpack", "archive_rows", "archive_fingerprint"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_no_cross_join_no_single_task(spark, name):
    text = plan(all_queries()[name](spark, SMALL))
    if name not in PYTHON:
        assert not re.search(r"Python|MapInArrow|MapInPandas|ArrowEval", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # a single partition is for aggregates without keys, which get one row per task
    for block in re.split(r"Exchange SinglePartition", text)[1:]:
        assert "partial_" in block[:1500], name


def test_nothing_is_broadcast_unasked_beyond_the_limit(spark):
    """With no table small enough, the joins are sort-merge joins and nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("leg_fare_merge", "border_anti_join", "final_mart"):
            text = plan(all_queries()[name](spark, SMALL))
            assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_spread_results_are_the_same_without_broadcasts(spark):
    names = ("leg_fare_merge", "border_anti_join", "live_year", "null_safe_join", "manifest_classify", "inventory_new")
    usual = {name: sorted(map(str, all_queries()[name](spark, SMALL).collect())) for name in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            assert sorted(map(str, all_queries()[name](spark, SMALL).collect())) == usual[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_scans_read_what_they_need(spark):
    text = plan(all_queries()["fare_route_month"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "o_totalprice" not in text and "c_acctbal" not in text


def test_month_slice_is_pushed_down(spark):
    text = plan(all_queries()["month_slice"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_one_view_folds_the_other_away(spark):
    text = plan(all_queries()["mirror_one_view"](spark, SMALL))
    assert "Generate" not in text and "Union" not in text


def test_the_cutoff_reaches_the_scan_of_a_stored_mart(spark, folder):
    rows = table(spark, SMALL, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.lit("GLO").alias("Airline Icao"), F.col("o_custkey").cast("string").alias("Voo"),
        F.lit("A").alias("Aero Icao"), F.lit("B").alias("OD Icao"), F.col("o_orderdate").cast("date").alias("Data"))
    rows.write.partitionBy("year", "month").parquet(folder + "/m")
    mart = spark.read.parquet(folder + "/m")
    future = years.future_flights(mart, mart.drop("year", "month"), 1997, ["Voo", "Data"], cutoff=F.lit(date(1997, 6, 30)))
    text = plan(future)
    assert "GreaterThan(Data,1997-06-30)" in text and "PartitionFilters: [isnotnull(year" in text


def test_year_is_a_partition_filter(spark, folder):
    table(spark, SMALL, "orders").selectExpr("*", "year(o_orderdate) as year", "month(o_orderdate) as month").write.partitionBy("year", "month").parquet(folder + "/m")
    mart = spark.read.parquet(folder + "/m")
    assert "PartitionFilters: [isnotnull(year" in plan(years.year_table(mart, 1997))
    assert "PartitionFilters: [isnotnull(year" in plan(years.stack(mart, 1996, 1998))
    assert mart.count() == table(spark, SMALL, "orders").count()
    assert markets  # the summaries read the departure view only, see test_plans


def test_fares_meet_the_rates_after_the_sum(spark):
    """The rate join sees routes, not fare rows: the aggregate is below the join."""
    text = plan(all_queries()["fare_class_month"](spark, SMALL))
    assert text.index("rate_key") < text.index("partial_sum")


def test_archives_are_handed_on_in_small_batches(spark):
    """A pandas UDF holds the texts and the archives of a whole batch; the archives are made one by one instead."""
    assert "ArrowEval" not in plan(all_queries()["archive_unpack"](spark, SMALL))


def test_no_leg_text_is_shuffled(spark):
    """The texts of a leg are written behind all joins: below the first shuffle of the plan there are only their sources."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for name in ("leg_enriched", "final_mart"):
            text = plan(all_queries()[name](spark, SMALL))
            top, below = text.split("Exchange", 1)
            assert "kg_payload" in top and "hr_partida_real" in top
            assert not re.search(r"kg_payload|hr_partida_real|nm_pais_destino", below), name
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_legs_are_not_shuffled_for_their_aircraft(spark):
    """The aircraft are chosen from all parts; as a stored table they have their own size, and are broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6k")
    try:
        text = plan(all_queries()["leg_enriched"](spark, SMALL))
        assert not re.search(r"Exchange hashpartitioning\(coalesce\((sg_equipamento_icao|Aircraft)", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_legs_meet_sums_and_fares_in_their_buckets(spark):
    """Neither legs nor lines are shuffled by a key, and what they are made of is joined once."""
    for name in ("leg_enriched", "leg_fare_merge", "final_mart"):
        text = plan(all_queries()[name](spark, SMALL))
        assert not re.search(r"Exchange hashpartitioning\([^\n]*(Chave|KeyTkt|l_orderkey)", text), name
        assert "Bucketed: true" in text and "lineitem.parquet" not in text, name


def test_wide_rows_are_made_by_methods_that_are_compiled(spark):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter; in one piece, wide rows had 22,000 bytes."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("leg_enriched", "leg_fare_merge", "final_mart"):
            execution = all_queries()[name](spark, SMALL)._jdf.queryExecution()
            code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(execution, "codegen")
            sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) <= 8000, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_legs_are_sorted_by_the_hash_of_their_key(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(all_queries()["leg_enriched"](spark, SMALL))
        assert re.search(r"SortMergeJoin \[_hash#\w+, year", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dates_are_read_before_a_leg_becomes_two_rows(spark):
    """Each date text was read once for either view, out of rows that were made by an interpreted expression."""
    text = plan(all_queries()["final_mart"](spark, SMALL))
    above = text.split("Generate explode", 1)[0]
    assert "inline(array(" not in text and len(above) < len(text) and "RLIKE" not in above


@pytest.mark.parametrize("buckets", ["3", "201"])
def test_buckets_are_read_without_a_shuffle(spark, folder, buckets):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    try:
        df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
        stored = bucketed(df.where("b <> 5"), ["a"], f"{folder}/rows")
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
        both = stored.groupBy("a", "b").count().join(stored.withColumn("c", F.lit(1)).hint("merge"), ["a", "b"])
        assert "Exchange" not in plan(both) and both.count() == 999
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_lines_keep_their_legs_sums_and_fares(spark, folder):
    """Null and repeated keys, hyphens and blanks in names: the same rows as with the raw legs, sums and fares joined as they are."""
    day = "timestamp '1998-07-14 03:04:05'"
    rows = {
        "region": "values (0, 'R') as t(r_regionkey, r_name)",
        "nation": "values (0, 'N', 0), (1, 'M', 0) as t(n_nationkey, n_name, n_regionkey)",
        "customer": "values (1L, 'C-1', 0, 'A-B'), (2L, 'C 2', 1, 'A'), (2L, 'C2', 0, 'A '), (3L, null, null, 'A'), (4L, 'C4', 1, null)"
                    " as t(c_custkey, c_name, c_nationkey, c_mktsegment)",
        "supplier": "values (1L, 'S1', 0), (2L, 'S2', 1), (2L, 'S2', null) as t(s_suppkey, s_name, s_nationkey)",
        "part": "values (1L, 'P', 'B', 'ECONOMY', 9, 5.5D), (1L, 'Q', 'B', 'SMALL', 8, 6.5D), (null, 'N', 'B', 'SMALL', 8, 6.5D)"
                " as t(p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)",
        "orders": f"select id as o_orderkey, id % 5 as o_custkey, 'F' as o_orderstatus, if(id = 6, null, {day}) as o_orderdate from range(9)",
        "lineitem": f"select id % 9 as l_orderkey, nullif(id % 3, 2) as l_partkey, 1 + id % 2 as l_suppkey, cast(1 + id % 4 as int) as l_linenumber,"
                    " cast(1 + id % 5 as double) as l_quantity, 1000.5D as l_extendedprice, 0.05D as l_discount, 0.02D as l_tax,"
                    f" 'A' as l_returnflag, if(id % 2 = 0, 'F', 'O') as l_linestatus, if(id % 11 = 3, null, {day}) as l_shipdate from range(90)",
    }
    for name, select in rows.items():
        spark.sql(select if select.startswith("select") else f"select * from {select}").write.parquet(f"{folder}/{name}.parquet")
    raw_legs, combined = spark_rows(spark, folder, raw.LEGS), spark_rows(spark, folder, raw.COMBINED)
    airports = spark_rows(spark, folder, raw.AIRPORTS)
    places = [airports.withColumn("OD ICAO", F.replace("OD ICAO", F.lit("A"), F.lit(x))) for x in "SC"]
    table_ = legs.leg_table(
        raw_legs, combined, dimensions.aircraft(spark_rows(spark, folder, raw.AIRCRAFT)), dimensions.airports(places[0].unionByName(places[1]))
    )
    expected = {"leg_enriched": table_, "final_mart": mart.mart(table_, routes.routes(spark, folder))}
    for name, df in expected.items():
        got = all_queries()[name](spark, folder)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name
    assert expected["final_mart"].where("`Tkt Avg` is not null").count() and table_.where("`CD Dest: PAX Pagos` > 0").count()


def test_equal_keys_have_equal_route_ends(spark):
    odd = ["A", "", "-", " ", "A-B", " A", "B -", "-A - B"]
    pairs = spark.createDataFrame([(a, b) for a in odd for b in odd], "a string, b string")
    ends = pairs.select(*[
        F.replace(F.substring_index(key, "-", -2), F.lit(" "), F.lit("")) == text.route_end(F.col("a"), F.col("b"))
        for key in (text.leg_key(F.lit("X"), F.lit("1"), F.col("a"), F.col("b")), text.fare_key(F.lit("X"), F.lit("1"), F.col("a"), F.col("b")))
    ])
    assert {value for row in ends.collect() for value in row} == {True}
