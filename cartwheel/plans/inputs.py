"""Warehouse inputs derived from one driver folder (built lazily, per query)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import COMMERCE_TZ, text_to_ms
from ..operators import cdc, logsplit
from ..sources import driver
from ..sources.tables import Tables


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    # -- click logs
    @cached_property
    def page_log(self) -> DataFrame:
        return driver.page_log(self.t.events)

    @cached_property
    def raw_log(self) -> DataFrame:
        return driver.raw_log(self.t.events)

    @cached_property
    def parsed_log(self) -> DataFrame:
        """Good lines, parsed, with the new-visitor flag repaired (T1 before the split)."""
        return logsplit.repaired_lines(self.raw_log)

    @cached_property
    def display_log(self) -> DataFrame:
        """Displays carry no visitor flag, so they skip the repair's extra pass."""
        return logsplit.display_log(logsplit.parse_lines(self.raw_log))

    # -- business rows
    @cached_property
    def order_info(self) -> DataFrame:
        return driver.order_info(self.t.orders, self.t.customer)

    @cached_property
    def order_amounts(self) -> DataFrame:
        """order_info for the statistics that read no province: no customer join."""
        return driver.order_info(self.t.orders, None)

    @cached_property
    def order_detail(self) -> DataFrame:
        return driver.order_detail(self.t.lineitem)

    @cached_property
    def payment_info(self) -> DataFrame:
        return driver.payment_info(self.t.orders)

    @cached_property
    def dims(self) -> dict:
        part = self.t.part
        return {
            "user": driver.dim_user_info(self.t.customer),
            "province": driver.dim_base_province(self.t.nation, self.t.region),
            "sku": driver.dim_sku_info(part),
            "spu": driver.dim_spu_info(part),
            "trademark": driver.dim_base_trademark(part),
            "category3": driver.dim_base_category3(part),
        }

    @property
    def as_of_ms(self):
        return text_to_ms(F.lit(driver.AGE_AS_OF), "UTC")

    # -- change records
    @cached_property
    def changes(self) -> DataFrame:
        raw = driver.debezium_changes(self.t.orders, self.t.lineitem)
        return cdc.normalize_changes(raw, keep=("key", "version"))

    @cached_property
    def config(self) -> DataFrame:
        return driver.table_process_config(self.spark)


TZ = COMMERCE_TZ
