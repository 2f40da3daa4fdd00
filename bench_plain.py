"""The same results the plain way, for comparison: one scan or join per figure, a window over
everything, a Python function per row. ``BENCH_COMPARE=1 python bench.py`` times both."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.plans.joined import LINE_ORDER
from docketry.plans.totals import FEE_COLUMNS
from docketry.sources.files import table


def fee_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A scan and a join per figure."""
    lines = table(spark, sf, "lineitem")
    out = lines.select("l_orderkey").distinct()
    for name, (flag, status) in FEE_COLUMNS.items():
        part = lines.filter((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status))
        out = out.join(part.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias(name)), "l_orderkey", "left")
    return out.fillna(0)


def latest_multi(spark: SparkSession, sf: str) -> DataFrame:
    """A maximum and a self-join per variant."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus")
    out = lines.select("l_orderkey").distinct()
    for name, cond in {"top": "true", "kept": "l_returnflag <> 'R'", "open": "l_linestatus = 'O'"}.items():
        top = lines.filter(cond).groupBy("l_orderkey").agg(F.max("l_linenumber").alias("l_linenumber"))
        back = lines.filter(cond).join(top, ["l_orderkey", "l_linenumber"]).groupBy("l_orderkey").agg(
            F.max("l_linenumber").alias(f"{name}_line"), F.max("l_shipdate").alias(f"{name}_ship")
        )
        out = out.join(back, "l_orderkey", "left")
    return out


def batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    """One task numbers every row."""
    rn = F.row_number().over(Window.orderBy("o_orderkey"))
    numbered = table(spark, sf, "orders").select("o_orderkey", (F.floor((rn - 1) / 250) + 1).alias("batch_id"))
    return numbered.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("o_orderkey"), F.max("o_orderkey"))


def clean_phone(spark: SparkSession, sf: str) -> DataFrame:
    """A Python function per row."""

    @F.udf("string")
    def clean(value):
        if value is None:
            return None
        value = re.sub(r"\s+", "", value)
        for mark in (".", ",", "()", ":", "*", ";", "?"):
            value = re.sub(f"^[{re.escape(mark)}]", "", value)
            value = re.sub(f"[{re.escape(mark)}]$", "", value)
        value = re.sub(r"[.\-]", "", value)
        value = re.sub("^0044", "+44", value).replace("(0)", "")
        return re.sub("^44", "+44", value).replace(")", "")

    number = F.concat(F.lit("0044 (0)7"), F.lpad(F.col("c_custkey").cast("string"), 9, "3"), F.lit("."))
    return table(spark, sf, "customer").select("c_custkey", clean(number).alias("phone"))


def render_template(spark: SparkSession, sf: str) -> DataFrame:
    """Nested rows handed to a Python function that fills the page."""

    @F.udf("string")
    def page(key, status, lines):
        rows = "".join(f"<tr><td>{r['l_linenumber']}</td><td>{r['l_returnflag']}</td><td>{r['l_shipdate']}</td></tr>" for r in lines or [])
        return "<html><h1>Order {{key}}</h1>{{status}}<table>{{rows}}</table></html>".replace("{{key}}", str(key)).replace(
            "{{status}}", status
        ).replace("{{rows}}", rows)

    child = F.struct(*LINE_ORDER, "l_returnflag")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(child)).alias("lines"))
    orders = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.select("o_orderkey", page("o_orderkey", "o_orderstatus", "lines").alias("page"))


PLAIN = {f.__name__: f for f in (fee_totals, latest_multi, batch_ids, clean_phone, render_template)}
