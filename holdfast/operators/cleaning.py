"""Cleaning and conformance of the raw customer feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import flag, strip, to_number, to_whole, yes_no


def trim_all(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    wanted = set(columns or df.columns)
    return df.select(*[strip(F.col(c).cast("string")).alias(c) if c in wanted else F.col(c)
                       for c in df.columns])


def conform_names(df: DataFrame, names: dict[str, str] = K.RAW_TO_CONFORMED) -> DataFrame:
    return df.withColumnsRenamed(names)


def first_per_key(df: DataFrame, key: list[str], arrival: str) -> DataFrame:
    """Keep the earliest row of each key. The limit of one row per key is applied
    before the shuffle too, so a key with very many copies does not travel."""
    w = W.partitionBy(*key).orderBy(arrival)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def impute_total(total: Column, monthly: Column, tenure: Column) -> Column:
    """Unbilled customers owe nothing; other gaps are estimated as monthly x tenure."""
    return F.coalesce(F.when(total.isNull() & (tenure == 0), F.lit(0.0)).otherwise(total),
                      monthly * tenure)


def total_class(text: Column | str) -> Column:
    """What the total says before imputation: blank, unparseable or ok."""
    return (F.when(F.col(text) == "", "blank")
            .when(to_number(text).isNull(), "unparseable").otherwise("ok"))


def conform_tagged(raw: DataFrame, arrival: str = "feed_seq") -> DataFrame:
    """``conform`` plus ``total_class``, which the cleaning report counts."""
    columns = [c for c in raw.columns if c != arrival]
    df = first_per_key(conform_names(trim_all(raw, columns)), ["customer_id"], arrival)
    tenure, monthly = to_whole("tenure_months"), to_number("monthly_charges")
    typed = {
        "tenure_months": tenure,
        "monthly_charges": monthly,
        "total_charges": impute_total(to_number("total_charges"), monthly, tenure),
        "senior_citizen": yes_no("senior_citizen"),
    }
    names = list(K.RAW_TO_CONFORMED.values())
    return df.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in names],
                     flag(F.col("churn") == "Yes").alias("churn_flag"),
                     total_class("total_charges").alias("total_class"))


def conform(raw: DataFrame, arrival: str = "feed_seq") -> DataFrame:
    """Raw text feed -> 22 typed columns, one row per customer.

    ``arrival`` is the column that says which copy of a customer came first.
    """
    return conform_tagged(raw, arrival).drop("total_class")


def unknown_values(df: DataFrame, domains: dict[str, tuple[str, ...]] = K.DOMAINS) -> DataFrame:
    """(column, value, rows) for every value outside its domain; NULLs are ignored.

    Only offending cells leave the scan, so a clean table explodes to nothing.
    """
    bad = [F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*allowed),
                  F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
           for c, allowed in domains.items()]
    cells = df.select(F.explode(F.array_compact(F.array(*bad))).alias("cell"))
    return (cells.groupBy("cell.column", "cell.value").agg(F.count("*").alias("rows")))


LISTED = 1000


def unknown_lists(unknown: DataFrame, most: int = LISTED) -> DataFrame:
    """(column, values, n_values): the first ``most`` unknown values of each column in their order, and how many there are,
    from ``unknown_values``, which is the whole list as rows. Tasks pass on ``most`` values a column at most."""
    first = F.row_number().over(W.partitionBy("column").orderBy("value"))
    lists = (unknown.select("column", "value").withColumn("_at", first).where(F.col("_at") <= most)
             .groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("values")))
    counts = unknown.groupBy("column").agg(F.count("*").alias("n_values"))
    return lists.join(counts, "column")


def unknown_map(unknown: DataFrame, most: int = LISTED) -> DataFrame:
    """One row with one map: column -> its unknown values (``unknown_lists``)."""
    entry = F.struct("column", "values")
    return unknown_lists(unknown, most).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("unknown"))


def cleaning_report(raw: DataFrame, arrival: str = "feed_seq",
                    tagged: DataFrame | None = None) -> DataFrame:
    """One row of counters over the whole feed. Pass the stored ``conform_tagged`` frame
    where there is one, so that the feed is not cleaned again to count it. The last counter is how many different
    unknown values the columns hold; ``unknown_values`` lists them."""
    df = conform_tagged(raw, arrival) if tagged is None else tagged
    kind = F.col("total_class")
    kept = df.agg(
        F.count("*").alias("rows_out"),
        F.count_if(kind == "blank").alias("total_charges_blank"),
        F.count_if((kind != "ok") & (F.col("tenure_months") == 0)).alias(
            "total_charges_imputed_zero"),
        F.count_if(kind == "unparseable").alias("total_charges_unparseable"))
    unknown = unknown_values(df).agg(F.count("*")).scalar()
    return kept.withColumn("rows_in", raw.select(F.count("*")).scalar()).select(
        "rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("duplicates_removed"),
        "total_charges_blank", "total_charges_imputed_zero", "total_charges_unparseable",
        unknown.alias("unknown_category_values"))
