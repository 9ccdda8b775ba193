"""Identity tables bound to the order, line-item and event tables of a data folder.

state = region name, district = nation name, pincode = 100000 + customer key.
The enrolment view carries deterministic dirt, so every quality rule has work.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.operators.skew import spread

DAY_TEXT = "dd-MM-yyyy"

class DriverInputs:
    """Lazy views over one folder; each property is a plan, nothing is cached."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def rows(self, name: str) -> int:
        """Row count of a table, which its files state."""
        if name not in self._rows:
            self._rows[name] = self.table(name).count()
        return self._rows[name]

    @property
    def feed_rows(self) -> list[int]:
        """About as many rows as ``enrolment``, ``demographic`` and ``biometric`` have."""
        return [self.rows(name) for name in ("orders", "lineitem", "events")]

    @cached_property
    def geo(self) -> DataFrame:
        """(c_custkey, state, district) of every customer."""
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "c_custkey", F.col("r_name").alias("state"), F.col("n_name").alias("district")
            )
        )

    @cached_property
    def enrolment(self) -> DataFrame:
        """Dirty enrolment counts: one row per order and a second copy of every 53rd."""
        orders = self.table("orders").join(self.geo, F.col("o_custkey") == F.col("c_custkey"))
        # one pass: each row is emitted once or twice, no second scan for the copies
        copies = F.when(_every(53), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = orders.withColumn("copy", F.explode(copies))
        price = F.col("o_totalprice")
        text_pin = (F.lit(100000) + F.col("o_custkey")).cast("string")
        small = F.floor(price) % 100
        changed = (F.col("copy") == 1) & _every(106)
        return rows.select(
            F.when(_every(103), "not-a-date")
            .otherwise(F.date_format("o_orderdate", DAY_TEXT))
            .alias("date"),
            F.when(_every(97), F.lit(None))
            .when(_every(101), "  ")
            .otherwise(F.col("state"))
            .alias("state"),
            F.when(_every(71), F.concat(F.lit(" "), F.lower("district"), F.lit(" ")))
            .otherwise(F.col("district"))
            .alias("district"),
            F.when(_every(89), F.concat(text_pin, F.lit(".0")))
            .when(_every(83), F.substring(text_pin, 1, 5))
            .otherwise(text_pin)
            .alias("pincode"),
            F.when(_every(79), -small - 1)
            .when(_every(61), F.lit(None))
            .otherwise(small)
            .cast("int")
            .alias("age_0_5"),
            (F.floor(price / 100) % 100).cast("int").alias("age_5_17"),
            (F.floor(price / 10000) + changed.cast("int")).cast("int").alias("age_18_greater"),
            (F.col("o_orderkey") * 2 + F.col("copy")).alias("ingest_seq"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with the state, district and customer of their order.

        Orders get their place first, so the line items themselves are shuffled once.
        """
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        placed = orders.join(self.geo, F.col("o_custkey") == F.col("c_custkey"))
        items = spread(self.table("lineitem"), ["l_orderkey"], self.rows("lineitem"))
        return items.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def demographic(self) -> DataFrame:
        return self.lines.select(
            F.date_format("l_shipdate", DAY_TEXT).alias("date"),
            "state",
            "district",
            (F.lit(100000) + F.col("o_custkey")).cast("string").alias("pincode"),
            F.floor("l_quantity").cast("int").alias("demo_age_5_17"),
            F.col("l_linenumber").alias("demo_age_17"),
        )

    @cached_property
    def biometric(self) -> DataFrame:
        day = F.date_sub(F.to_date("ts"), 9000)
        return (
            self.table("events")
            .join(self.geo, F.col("user_id") == F.col("c_custkey"))
            .select(
                F.date_format(day, DAY_TEXT).alias("date"),
                "state",
                "district",
                (F.lit(100000) + F.col("user_id")).cast("string").alias("pincode"),
                F.floor("value").cast("int").alias("bio_age_5_17"),
                (F.col("event_id") % 10).cast("int").alias("bio_age_17"),
            )
        )

    @cached_property
    def changes(self) -> DataFrame:
        """A change log: events as inserts, updates and deletes of a user's value per type."""
        number = F.col("event_id") % 10
        kind = F.when(number == 0, "delete").when(number < 4, "insert").otherwise("update")
        return self.table("events").select(
            "user_id", "event_type", "event_id", kind.alias("kind"), "value", F.to_date("ts").alias("day")
        )

    @cached_property
    def spellings(self) -> DataFrame:
        """The nation of each customer, misspelt now and then: a letter lost, doubled or changed."""
        nations = self.table("nation").select("n_nationkey", F.concat(F.lit("The "), "n_name").alias("name"))
        rows = self.table("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))

        def every(n: int) -> Column:
            return F.col("c_custkey") % n == 0

        return rows.select(
            F.when(every(97), F.replace("name", F.lit("ATI"), F.lit("TI")))
            .when(every(89), F.replace("name", F.lit("ATI"), F.lit("AATI")))
            .when(every(83), F.replace("name", F.lit("ATI"), F.lit("ETI")))
            .when(every(79), F.upper(F.concat(F.lit("  "), "name")))
            .when(every(73), F.lit(None))
            .when(every(71), F.lit("  "))
            .otherwise(F.col("name"))
            .alias("label")
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Events as JSON messages of a feed, some of them broken."""

        def every(n: int) -> Column:
            return F.col("event_id") % n == 0

        def pair(name: str, value: Column) -> Column:
            return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

        body = F.concat_ws(
            ",",
            pair("date", F.date_format("ts", "d-M-yyyy")),
            pair("state", F.col("event_type")),
            pair("pincode", (F.col("user_id") + 100000).cast("string")),
            pair("age_0_5", (F.col("event_id") % 7).cast("string")),
            F.when(every(11), pair("camp", (F.col("event_id") % 5).cast("string"))),
        )
        value = (
            F.when(every(29), F.lit(None))
            .when(every(23), "[1,2]")
            .when(every(19), F.concat(F.lit("{"), body))
            .when(every(17), '{"camp":"1"}')
            .otherwise(F.concat(F.lit("{"), body, F.lit("}")))
        )
        return self.table("events").select(
            value.cast("binary").alias("value"),
            F.lit("feed").alias("topic"),
            (F.col("event_id") % 3).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("timestamp"),
        )

    @cached_property
    def aliases(self) -> DataFrame:
        """District alias table: lower-case nation name to its printed name."""
        return self.table("nation").select(
            F.lower("n_name").alias("alias"), F.col("n_name").alias("canonical")
        )


def _every(n: int) -> Column:
    return F.col("o_orderkey") % n == 0
