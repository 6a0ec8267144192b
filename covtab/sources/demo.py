"""Role tables derived, by Spark, from the TPC-H-like test tables.

The original job reads person-level health tables that are not public. To
exercise every operator on public data at any scale, this module maps the
driver's ``orders`` / ``lineitem`` / ``supplier`` / ``nation`` / ``region`` /
``customer`` tables onto the five roles (mapping in FIXTURES.md section 2).
Whole tables are read. Rules on keys add the cases that a report must stand:

* facts: one row per line item (orders without lines keep one row). The entity
  is the customer; every 101st order has none. The concept is the order
  priority with the line's return flag, or a rare one; the direct field is the
  order status; both dates are months, every 89th order has no record date.
  Every line names its supplier as the facility. Unspecified orders in which
  the direct field is unknown too belong, every 7th, to guests: entities of
  their own, without a known category, registered with a region's office.
* concept map: ten categories, one outside the domain, unknown codes, unmapped
  concepts, and every row twice.
* facilities: suppliers, every tenth closed before the as-of day, and regional
  offices.
* orgs: nations and regions. Nation 24 has no code, nation 23 closes on the
  as-of day, nation 19 has no name, nations 20 and 21 share one, nation 5 has
  two valid records, and no entity of a region's org is known.
* secondary asset: the customer's market segment as a category (one outside
  the domain), from all orders: every fifth contradicts it, some have none,
  and every 40th customer's rows come twice.

The facts grow with ``lineitem``; everything else grows with ``orders`` or
is a dimension.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab.sources.tables import conform, SCHEMAS

# Fixed values of the demo mapping.
DEMO_ASOF = _dt.date(2001, 8, 1)
DEMO_DAYS = (_dt.date(1990, 1, 4), _dt.date(1999, 12, 31), DEMO_ASOF)
CONCEPT_TO_CATEGORY = {
    "1-URGENT/A": "A", "1-URGENT/N": "B", "1-URGENT/R": "C", "2-HIGH/A": "D", "2-HIGH/N": "E", "2-HIGH/R": "F",
    "3-MEDIUM/A": "G", "3-MEDIUM/N": "H", "3-MEDIUM/R": "J", "4-NOT SPECIFIED/A": "Z", "4-NOT SPECIFIED/N": "99",
    "4-NOT SPECIFIED/R": "", "5-LOW/A": "Q", "5-LOW/R": "K", "RARE": "W",
}
STATUS_TO_DIRECT = {"F": "A", "O": "B", "P": "X"}
SEGMENT_TO_ASSET = {"AUTOMOBILE": "A", "BUILDING": "B", "FURNITURE": "C", "HOUSEHOLD": "D", "MACHINERY": "Q"}
ASSET_SOURCE = "combined_asset"
GUEST_PRIORITY, GUEST_STATUS = "4-NOT SPECIFIED", "P"
REGIONS = 5
RETURN_FLAGS = ("A", "N", "R")


def _case(col, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def _month_start(ts) -> F.Column:
    return F.trunc(F.to_date(ts), "MM")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(prefix: str, key) -> F.Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def demo_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    guest = (F.col("o_orderpriority") == GUEST_PRIORITY) & (F.col("o_orderstatus") == GUEST_STATUS) & (order % 7 == 0)
    rare = (F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45) & ~guest
    month = _month_start("o_orderdate")
    df = joined.select(
        F.when(order % 101 == 0, F.lit(None).cast("string")).when(guest, _text("G", cust)).otherwise(
            cust.cast("string")).alias("entity_id"),
        F.when(guest, _text("R", cust % REGIONS)).otherwise(F.col("l_suppkey").cast("string")).alias("facility_code"),
        F.when(rare, F.lit("RARE")).otherwise(F.concat_ws("/", "o_orderpriority", "l_returnflag")).alias("concept_code"),
        F.when(order % 89 != 0, month).alias("record_date"),
        _case(F.col("o_orderstatus"), STATUS_TO_DIRECT).alias("direct_category"),
        month.alias("period_end"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"),
               F.to_date("o_orderdate")).alias("death_date"),
    )
    return conform(df, SCHEMAS["facts"])


def demo_concept_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every concept that a fact can have, from the orders alone: a fact's order may have no line.
    priorities = _read(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    marks = [F.concat_ws("/", "o_orderpriority", *([F.lit(m)] if m else [])) for m in (None, *RETURN_FLAGS)]
    codes = priorities.select(F.explode(F.array(*marks, F.lit("RARE"))).alias("concept_code")).distinct()
    rows = codes.withColumn("category", _case(F.col("concept_code"), CONCEPT_TO_CATEGORY))
    return conform(rows.union(rows), SCHEMAS["concept_map"])


def demo_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("facility_code"), _text("N", F.col("s_nationkey")).alias("org_code"),
        F.date_add(F.lit(_dt.date(1990, 1, 1)), (F.col("s_suppkey") % 7).cast("int")).alias("opened"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit(_dt.date(2000, 1, 1))).alias("closed"))
    code = _text("R", F.col("r_regionkey"))
    offices = _read(spark, sf_dir, "region").select(
        code.alias("facility_code"), code.alias("org_code"), F.lit(_dt.date(1990, 1, 1)).alias("opened"),
        F.lit(None).cast("date").alias("closed"))
    df = s.union(offices).select(
        "facility_code", "org_code", F.col("opened").alias("open_date"), F.col("closed").alias("close_date"),
        F.col("opened").alias("record_start"), F.col("closed").alias("record_end"))
    return conform(df, SCHEMAS["facilities"])


def demo_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    key = F.col("n_nationkey")
    no_text = F.lit(None).cast("string")
    nations = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.when(key == 24, no_text).otherwise(_text("N", key)).alias("org_code"),
        F.when(key == 19, no_text).when(key.isin(20, 21), F.lit("SHARED NAME")).otherwise(F.col("n_name")).alias("org_name"),
        F.col("r_name").alias("national_grouping"), F.col("n_regionkey").alias("region"), key.alias("number"),
        F.when(key == 23, F.lit(DEMO_ASOF)).alias("closed"))
    regions = r.select(
        _text("R", F.col("r_regionkey")).alias("org_code"), F.col("r_name").alias("org_name"),
        F.col("r_name").alias("national_grouping"), F.col("r_regionkey").alias("region"),
        (F.col("r_regionkey") + 100).alias("number"), F.lit(None).cast("date").alias("closed"))
    again = nations.where("number = 5").withColumn("org_name", F.concat("org_name", F.lit(" (SECOND RECORD)")))
    number = F.col("number").cast("string")
    df = nations.union(regions).union(again).select(
        "org_code", "org_name", "national_grouping",
        _text("G", F.col("region")).alias("high_level_geography"),
        F.concat("org_name", F.lit(" HOUSE")).alias("address_line_1"),
        F.concat(F.lit("STREET "), number).alias("address_line_2"),
        no_text.alias("address_line_3"),
        no_text.alias("address_line_4"),
        no_text.alias("address_line_5"),
        F.concat(F.lit("PC"), F.lpad(number, 3, "0")).alias("postcode"),
        F.lit(_dt.date(1990, 1, 1)).alias("open_date"),
        F.col("closed").alias("close_date"),
        F.lit("C").alias("sub_type_code"),
        F.lit(_dt.date(1990, 1, 1)).alias("record_start"),
        F.lit(None).cast("date").alias("record_end"),
        F.lit(_dt.date(1990, 1, 1)).alias("created_on"),
        F.lit(_dt.date(2000, 1, 1)).alias("updated_on"),
    )
    return conform(df, SCHEMAS["orgs"])


def demo_asset_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A secondary asset with a row for every order: so many rows that counting
    them, as the original did, makes more known entities than there are."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    order = F.col("o_orderkey")
    category = F.when(order % 5 == 0, F.lit("E")).when(order % 499 != 0, _case(F.col("c_mktsegment"), SEGMENT_TO_ASSET))
    df = orders.join(customers, orders.o_custkey == customers.c_custkey, "left").select(
        F.col("o_custkey").cast("string").alias("entity_id"), category.alias("category"),
        F.to_date("o_orderdate").alias("attributed_on"), F.lit(ASSET_SOURCE).alias("source"), "o_custkey")
    return df


def demo_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo_asset_by_order(spark, sf_dir).groupBy("entity_id", "category", "source", "o_custkey").agg(
        F.max("attributed_on").alias("attributed_on"))
    return conform(rows.union(rows.where(F.col("o_custkey") % 40 == 0)), SCHEMAS["asset"])


def demo_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five role tables for one test-data folder."""
    return {
        "facts": demo_facts(spark, sf_dir),
        "concept_map": demo_concept_map(spark, sf_dir),
        "facilities": demo_facilities(spark, sf_dir),
        "orgs": demo_orgs(spark, sf_dir),
        "asset": demo_asset(spark, sf_dir),
    }
