"""Sales-pipeline tables derived from an order-management star schema.

``orders`` become opportunities, ``lineitem`` bookings, nations and regions the
raw and clean sales divisions. Attributes the star schema lacks (flags, missing
currencies, blank accounts, refunds) follow from the keys, so that every filter of
the forecast has rows to keep and rows to drop; no order or line is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipecast import schemas
from pipecast.config import EXCLUDED_BOOKING_IDS, EXCLUDED_OPPORTUNITY_IDS, STAGES
from pipecast.functions.fiscal import day_of_quarter, quarter_end, quarter_label, quarter_start
from pipecast.sources.readers import Sources, conform

# The longest an order is followed as an opportunity, in days.
LONGEST_LIFE = 150

_LIFE = "20 + (o_orderkey * 37) % 131"


class OrderTables:
    """Lazy readers of the star schema's parquet files."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def customer_labels(self) -> DataFrame:
        """Customer with nation and region name.

        A nation is a row, a region too; left to itself, the planner sends all customers to them, because
        it takes a join's size for the product of its sides.
        """
        nation = self.read("nation").join(
            F.broadcast(self.read("region")), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.read("customer")
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "n_name", "r_name")
        )

    def spread(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` dealt over the cores if table ``name`` has fewer splits than there are cores.

        For rows that are about to be multiplied; a table of many splits is left where it is read.
        """
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if self.read(name).rdd.getNumPartitions() < cores else df

    def orders(self) -> DataFrame:
        """Orders with their customer's labels and the order date as ``od``.

        Both sides grow with the business, so neither passes through the driver.
        """
        orders = self.read("orders").withColumn("od", F.to_date("o_orderdate"))
        return orders.join(self.customer_labels.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))


def opportunity_history(
    tables: OrderTables, first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """One row per order and day of its life, walking through the five stages.

    Whatever does not change from day to day is computed ahead of the explode. With bounds, only
    orders are read that can have a day between them; their other days are not cut off.
    """
    stages = ", ".join(f"'{stage}'" for stage in STAGES)
    orders = tables.orders()
    if first is not None and last is not None:
        placed = F.col("o_orderdate")
        orders = orders.where((placed >= F.date_sub(first, LONGEST_LIFE)) & (placed < F.date_add(last, 1)))
    orders = tables.spread(orders, "orders")
    orders = orders.selectExpr(
        "o_orderkey",
        f"if(o_orderkey = 1, '{EXCLUDED_OPPORTUNITY_IDS[0]}', cast(o_orderkey as string)) as id",
        "od",
        f"cast({_LIFE} as int) as life",
        "if(o_orderkey % 97 = 0, 0, cast(o_totalprice as decimal(18, 2))) as amount",
        "element_at(array(null, 'USD', 'EUR', 'GBP'), cast(o_orderkey % 4 as int) + 1) as currencyisocode",
        "if(o_orderkey % 17 = 0, concat('gone', o_custkey), cast(o_custkey as string)) as accountid",
        "if(o_orderkey % 7 = 0, null, cast(od as timestamp)) as lastactivitydate",
        "o_orderkey % 50 = 0 as isdeleted",
        "o_orderstatus = 'F' as finished",
        "n_name as owner_division__c",
    )
    days = orders.withColumn("k", F.explode(F.expr("sequence(0, life - 1)")))
    rows = days.selectExpr(
        "id",
        "date_add(od, k) as dt",
        f"element_at(array({stages}), cast(k * 5 div life as int) + 1) as stagename",
        "amount",
        "currencyisocode",
        "accountid",
        "lastactivitydate",
        "cast(if(o_orderkey % 3 = 0, od, date_add(od, cast(k div 60 * 60 as int))) as timestamp)"
        " as lastmodifieddate",
        "isdeleted",
        "finished and k * 4 >= life * 3 as isclosed",
        "date_add(od, life) as closedate",
        "owner_division__c",
    )
    return conform(rows, schemas.OPPORTUNITY_HISTORY)


def bookings(tables: OrderTables) -> DataFrame:
    """One row per order line. Orders get their labels ahead of the join of the two facts, which the
    planner joins them by their measured sizes."""
    lines = tables.read("lineitem")
    orders = tables.orders().select("o_orderkey", "o_custkey", "n_name")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        f"if(l_orderkey = 1 and l_linenumber = 1, '{EXCLUDED_BOOKING_IDS[0]}',"
        " concat(l_orderkey, '-', l_linenumber)) as id",
        "cast(l_shipdate as date) as booking_date__c",
        "cast(if(l_partkey % 5 = 0, l_quantity, l_extendedprice) as decimal(18, 2))"
        " * if(l_tax = 0.08 and l_quantity = 50, -1, 1) as amount__c",
        "n_name as owner_division__c",
        "case when l_linenumber = 7 then 'Renewal' when l_returnflag = 'A' then 'New'"
        " when l_returnflag = 'N' then 'New Order' else 'Upsell' end as order_type__c",
        "case when l_discount > 0.08 then 'C10' when l_discount = 0 then '' end as coupon__c",
        "if(l_tax = 0.08, 'Y', 'N') as bookingexception__c",
        "if(l_suppkey % 20 = 0, 'API Integration User', concat('sup', l_suppkey)) as owner_name",
        "case when o_custkey % 41 = 0 then '' when o_custkey % 43 = 0 then null"
        " else cast(o_custkey as string) end as account__c",
        "l_linestatus = 'F' and l_orderkey % 30 = 0 as isdeleted",
    )
    return conform(rows, schemas.BOOKINGS)


def quota(tables: OrderTables) -> DataFrame:
    """Half of a region's ordered amount per quarter, as a ``Segment`` line and a ``Rep`` copy of it."""
    total = F.sum(F.col("o_totalprice").cast(schemas.MONEY)).cast(schemas.MONEY)
    lines = (
        tables.orders()
        .groupBy(quarter_start(F.col("od")).alias("qtr_start"), "r_name")
        .agg((total * F.lit(0.5).cast("decimal(2, 1)")).alias("gross_quota__c"))
    )
    rows = lines.select(
        F.col("qtr_start").alias("start_date__c"),
        F.concat(F.lit("quota."), "r_name").alias("email__c"),
        "gross_quota__c",
        F.explode(F.array(F.lit("Segment"), F.lit("Rep"))).alias("quota_owner_type__c"),
    )
    return conform(rows, schemas.QUOTA)


def quarter_mapping(tables: OrderTables) -> DataFrame:
    """Every fiscal quarter from the first order to the end of the last opportunity."""
    span = tables.read("orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    first = quarter_start(F.lit(span[0]).cast("date"))
    last = quarter_start(F.date_add(F.lit(span[1]).cast("date"), LONGEST_LIFE))
    starts = tables.spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 3 months"))).alias("qtr_start")
    )
    rows = starts.select(
        quarter_label(F.col("qtr_start")).alias("fy_quarter"),
        "qtr_start",
        quarter_end(F.col("qtr_start")).alias("qtr_end"),
    )
    return conform(rows, schemas.QUARTER_MAPPING)


def calendar(quarters: DataFrame) -> DataFrame:
    """Every day of ``quarters`` with its number in the quarter."""
    days = quarters.select("qtr_start", F.explode(F.sequence("qtr_start", "qtr_end")).alias("dt"))
    return conform(
        days.select("dt", day_of_quarter(F.col("dt"), F.col("qtr_start")).alias("day_of_fiscal_quarter")),
        schemas.CALENDAR,
    )


def division_map(tables: OrderTables, together: bool) -> DataFrame:
    """Nation (opportunities, bookings) and quota owner to region.

    Region 4 becomes the excluded ``Channel``; ``together`` merges regions 1 to 3
    into ``Intl``. Nation 24 is left unmapped.
    """
    merged = "when r_regionkey between 1 and 3 then 'Intl'" if together else ""
    regions = tables.read("region").selectExpr(
        "r_regionkey", "r_name", f"case when r_regionkey = 4 then 'Channel' {merged} else r_name end as clean"
    )
    nations = (
        tables.read("nation")
        .where("n_nationkey <> 24")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_name", "clean")
    )
    owners = regions.select(F.concat(F.lit("quota."), "r_name"), "clean")
    return conform(nations.union(owners).toDF("sales_div_dirty", "sales_div_clean"), schemas.DIVISION_MAP)


def currency(tables: OrderTables) -> DataFrame:
    """The currencies orders are placed in: three literal rows."""
    rows = tables.spark.sql("VALUES ('USD', 1.0), ('EUR', 1.1), ('GBP', 1.3) AS t(alphabeticcode, rate)")
    return conform(rows, schemas.CURRENCY)


def account(tables: OrderTables) -> DataFrame:
    return conform(tables.read("customer").select(F.col("c_custkey").alias("id")), schemas.ACCOUNT)


def derive_sources(spark: SparkSession, folder: str, together: bool = False) -> Sources:
    """All forecast sources from the star schema in ``folder``.

    The calendar follows from the first and last order date, looked up once. Everything
    else stays lazy, so nothing is stored.
    """
    tables = OrderTables(spark, folder)
    quarters = quarter_mapping(tables)
    return Sources(
        opportunity_history=opportunity_history(tables),
        bookings=bookings(tables),
        quota=quota(tables),
        quarter_mapping=quarters,
        calendar=calendar(quarters),
        division_map=division_map(tables, together),
        currency=currency(tables),
        account=account(tables),
        history_between=lambda first, last: opportunity_history(tables, first, last),
    )
