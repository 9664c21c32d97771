"""Customer, telemetry and monthly frames derived from the order and event tables.

The feeds of a retention team are bound to the tables at hand: orders give the
customer snapshot (tenure, charges, label), events give the usage telemetry and
order lines give a long monthly series. Everything is computed from the tables;
the small dirt in the raw feed (blanks, text totals, repeats, padding) follows
from order attributes, so the cleaning operators meet it at every scale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.columns import (flag, left_closed_band, logistic, month_ordinal,
                                        month_text, round_even, units)
from holdfast import contract as K

Tables = Callable[[str], DataFrame]

# Fixed values of the binding
SNAPSHOT_ORDINAL = 2001 * 12 + 8
CHURN_BEFORE = "2000-08-01"
PRICE_SCALE = 2500
CONTRACT_OF_REGION = {"AFRICA": "Month-to-month", "AMERICA": "Month-to-month",
                      "ASIA": "One year", "EUROPE": "One year", "MIDDLE EAST": "Two year"}
INTERNET_OF_SEGMENT = {"BUILDING": "Fiber optic", "AUTOMOBILE": "Fiber optic",
                       "MACHINERY": "DSL", "HOUSEHOLD": "DSL", "FURNITURE": "No"}
PAYMENT_OF_PRIORITY = {"1-URGENT": "Electronic check", "2-HIGH": "Mailed check",
                       "3-MEDIUM": "Bank transfer (automatic)", "4-NOT SPECIFIED": "Not specified",
                       "5-LOW": "Credit card (automatic)"}
ADDON_OF_PRIORITY = {"online_security": "1-URGENT", "online_backup": "2-HIGH",
                     "device_protection": "3-MEDIUM", "tech_support": "4-NOT SPECIFIED",
                     "streaming_tv": "5-LOW"}


def tables_at(spark: SparkSession, sf_dir: str) -> Tables:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


def _cents_text(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."),
                    F.lpad((c % 100).cast("string"), 2, "0"))


def order_history(t: Tables) -> DataFrame:
    """One row per ordering customer.

    The latest order needs a struct maximum, which Spark can only aggregate by
    sorting; apart from the numbers it leaves those to the hash aggregate. Both sides
    end up partitioned by customer, so joining them moves nothing.
    """
    o, prio = t("orders"), F.col("o_orderpriority")
    numbers = o.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.countDistinct(month_ordinal("o_orderdate")).alias("n_months"),
        F.sum(units("o_totalprice", 2)).alias("price_cents"),
        F.min(month_ordinal("o_orderdate")).alias("first_month"),
        F.max("o_orderdate").alias("last_order"),
        *[F.sum(flag(prio == p)).alias(f"n_{a}") for a, p in ADDON_OF_PRIORITY.items()],
        F.sum(flag(F.col("o_orderstatus") == "F")).alias("n_streaming_movies"),
        F.sum(flag(F.col("o_orderstatus") == "P")).alias("n_pending"))
    latest = o.groupBy("o_custkey").agg(F.max(F.struct(
        "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")).alias("latest"))
    return numbers.join(latest, "o_custkey")


def raw_feed(t: Tables) -> DataFrame:
    """The 21 text columns of the customer feed plus ``feed_seq``, the arrival order."""
    c = (t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
         .join(order_history(t), F.col("c_custkey") == F.col("o_custkey"), "left"))
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    status = F.col("latest.o_orderstatus")
    total = F.rint(F.col("price_cents") / PRICE_SCALE).cast("bigint")
    monthly = F.rint(F.col("price_cents") / (F.col("n_months") * PRICE_SCALE)).cast("bigint")
    internet = _mapped(F.col("c_mktsegment"), INTERNET_OF_SEGMENT)
    phone = F.when(nation % 10 == 0, "No").otherwise("Yes")

    def yes(condition: Column) -> Column:
        return F.when(condition, "Yes").otherwise("No")

    def addon(name: str) -> Column:
        return F.when(internet == "No", "No internet service").otherwise(
            yes(F.col(f"n_{name}") >= 2))

    # a customer whose latest order is pending is sent again with a worthless correction
    copies = F.explode(F.when(status == "P", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))))
    again = F.col("copy") == 1
    padded = F.concat(F.when(key % 2 == 0, " ").otherwise(""), F.lit("C"), key.cast("string"),
                      F.when(key % 3 == 0, "\t").otherwise(""))
    payment = F.coalesce(_mapped(F.col("latest.o_orderpriority"), PAYMENT_OF_PRIORITY),
                         F.lit("Mailed check"))
    total_text = (F.when(F.col("n_orders").isNull(), " ")
                  .when((status == "P") & (nation % 5 == 0), "n/a")
                  .when(nation == 24, "")
                  .otherwise(_cents_text(total)))
    return c.select("*", copies.alias("copy")).select(
        (key * 2 + F.col("copy")).alias("feed_seq"),
        padded.alias("customerID"),
        F.when(nation % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(F.col("c_acctbal") < 0, "1").otherwise("0").alias("SeniorCitizen"),
        yes(F.col("n_pending") >= 4).alias("Partner"),
        yes(F.col("c_acctbal") > 5000).alias("Dependents"),
        F.coalesce(F.lit(SNAPSHOT_ORDINAL) - F.col("first_month"), F.lit(0)).cast("string").alias(
            "tenure"),
        phone.alias("PhoneService"),
        F.when(phone == "No", "No phone service").otherwise(yes(F.col("n_orders") >= 10)).alias(
            "MultipleLines"),
        internet.alias("InternetService"),
        addon("online_security").alias("OnlineSecurity"),
        addon("online_backup").alias("OnlineBackup"),
        addon("device_protection").alias("DeviceProtection"),
        addon("tech_support").alias("TechSupport"),
        addon("streaming_tv").alias("StreamingTV"),
        addon("streaming_movies").alias("StreamingMovies"),
        _mapped(F.col("r_name"), CONTRACT_OF_REGION).alias("Contract"),
        F.when(nation % 3 == 0, "No").otherwise("Yes").alias("PaperlessBilling"),
        F.when(again, "Mailed check").otherwise(payment).alias("PaymentMethod"),
        _cents_text(F.coalesce(monthly, F.lit(0))).alias("MonthlyCharges"),
        F.when(again, "0").otherwise(total_text).alias("TotalCharges"),
        F.when(F.col("last_order") >= F.lit(CHURN_BEFORE).cast("timestamp_ntz"), "No").otherwise(
            "Yes").alias("Churn"))


def telemetry(t: Tables) -> DataFrame:
    """Customer-month telemetry: the event days of a month stand for the 12 window months."""
    e, cents = t("events"), units("value", 2)
    kind = F.col("event_type")
    index = F.least(F.expr("(dayofmonth(ts) - 1) * 12 div 30 + 1").cast("int"), F.lit(12))
    agg = (e.select("user_id", "event_type", "value", index.alias("month_index"))
           .groupBy("user_id", "month_index").agg(
               F.count("*").alias("n"),
               F.sum(flag(kind == "error")).alias("errors"),
               F.sum(F.when(kind == "view", cents)).alias("view_cents"),
               F.count(F.when(kind == "view", 1)).alias("views"),
               F.sum(F.when(kind == "click", cents)).alias("click_cents"),
               F.count(F.when(kind == "click", 1)).alias("clicks"),
               F.coalesce(F.sum(F.when(kind == "error", cents)), F.lit(0)).alias("error_cents"),
               F.sum(cents).alias("all_cents"),
               F.sum(flag((kind == "error") & (F.col("value") > 100))).alias("complaints")))

    def mean(total: str, count: str) -> Column:
        return round_even(F.col(total) / (F.nullif(F.col(count), F.lit(0)) * 100).cast("double"), 1)

    return agg.select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("2025-"), F.lpad(F.col("month_index").cast("string"), 2, "0")).alias("month"),
        "month_index",
        round_even(F.col("errors") * 10.0 / F.col("n"), 3).alias("dropped_call_pct"),
        mean("view_cents", "views").alias("avg_download_mbps"),
        mean("click_cents", "clicks").alias("avg_latency_ms"),
        F.floor(F.col("error_cents") / 400).cast("bigint").alias("outage_minutes"),
        round_even(F.col("all_cents") / F.lit(100.0), 1).alias("data_usage_gb"),
        "complaints")


def monthly(t: Tables) -> DataFrame:
    """Customer x order month over the whole history, for calendar measures.

    Order lines are summed per order before the join, so an order with very many
    lines joins as one row.
    """
    net = units("l_extendedprice", 2) * (100 - units("l_discount", 2))
    lines = t("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum(net).alias("net"),
        F.sum(flag(F.col("l_returnflag") == "R")).alias("returned"))
    o = t("orders").select("o_orderkey", "o_custkey",
                           month_ordinal("o_orderdate").alias("month_ordinal"))
    agg = (o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
           .groupBy("o_custkey", "month_ordinal").agg(
               F.sum("lines").alias("lines"), F.sum("returned").alias("outage_minutes"),
               F.sum("net").alias("net")))
    text = month_text(F.col("month_ordinal"))
    return agg.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        text.alias("month"), F.replace(text, F.lit("-"), F.lit("")).cast("int").alias("month_key"),
        "month_ordinal", "lines", "outage_minutes",
        (F.col("net") / F.lit(10000.0)).alias("revenue"))


def rule_scores(features: DataFrame) -> DataFrame:
    """Scores of a fixed points rule, for queries whose answer must not depend on a fit."""
    z = (-1.0 + 1.2 * F.col("is_month_to_month") - 0.02 * F.col("tenure_months")
         - 0.15 * F.col("num_addon_services") + 0.01 * F.col("monthly_charges")
         + 0.3 * flag(F.col("payment_method") == "Electronic check"))
    scored = features.withColumn("churn_probability", round_even(logistic(z), 4))
    return scored.withColumn("risk_band", left_closed_band("churn_probability", K.RISK_BANDS))
