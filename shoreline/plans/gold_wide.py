"""KPI reports over the wide domain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.functions import measures
from shoreline.functions.temporal import calendar_days, day_of
from shoreline.operators.rows import purchases, successful
from shoreline.operators.shape import align, round_columns, stamp
from shoreline.plans.gold import cells_with_baseline, with_baseline

# Levels of grouping_id() over (payment_method, currency).
BY_METHOD, BY_CURRENCY, OVERALL = 1, 2, 3


def revenue_breakdown(transactions: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Revenue of successful transactions: overall, by payment method and by currency.

    The rows are first reduced to one per method, currency and user. The three
    groupings then expand that reduced set instead of the raw rows.
    ``conversion_rate`` is a fraction, given on the overall row only.
    """
    known = align(transactions, {k: schemas.WIDE_DOMAINS["transactions"][k] for k in (
        "txn_id", "user_id", "amount", "payment_method", "currency", "status", "payment_status")})
    per_user = (
        successful(known)
        .groupBy("payment_method", "currency", "user_id")
        .agg(
            F.sum("amount").alias("amount"),
            F.count("amount").alias("amounts"),
            F.count("txn_id").alias("transactions"),
            F.count("*").alias("rows"),
        )
    )
    report = per_user.groupingSets(
        [[], ["payment_method"], ["currency"]], "payment_method", "currency"
    ).agg(
        F.grouping_id().alias("level"),
        F.sum("amount").alias("total_revenue"),
        F.sum("transactions").alias("transaction_count"),
        measures.ratio(F.sum("amount"), F.sum("amounts")).alias("avg_transaction_value"),
        F.count_distinct("user_id").alias("unique_customers"),
        F.sum("rows").alias("rows"),
    )
    conversion = F.lit(None).cast("double")
    if events is not None:
        n_events = events.agg(F.count("*").alias("n")).scalar()
        rate = F.coalesce(measures.ratio(F.col("rows"), n_events), F.lit(0.0))
        conversion = F.when(F.col("level") == OVERALL, rate)
    return report.select(
        F.when(F.col("level") == OVERALL, "overall")
        .when(F.col("level") == BY_METHOD, "payment_method")
        .otherwise("currency").alias("breakdown_type"),
        F.when(F.col("level") == OVERALL, F.lit("all"))
        .when(F.col("level") == BY_METHOD, F.col("payment_method"))
        .otherwise(F.col("currency")).alias("breakdown_value"),
        F.round("total_revenue", 2).alias("total_revenue"),
        "transaction_count",
        F.round("avg_transaction_value", 2).alias("avg_transaction_value"),
        "unique_customers",
        conversion.alias("conversion_rate"),
    )


def activity_span(events: DataFrame, drop_anonymous: bool = False) -> DataFrame:
    """First and last activity per user. Rows without a user form one entry unless dropped."""
    if drop_anonymous:
        events = events.where(F.col("user_id").isNotNull())
    return (
        events.groupBy("user_id")
        .agg(
            F.min("timestamp").alias("first_activity"),
            F.max("timestamp").alias("last_activity"),
            F.count("event_id").alias("total_events"),
        )
        .withColumns({
            "cohort_date": day_of("first_activity"),
            "last_active_date": day_of("last_activity"),
            "days_active": calendar_days("last_activity", "first_activity"),
        })
    )


def retention_span(events: DataFrame, drop_anonymous: bool = False) -> DataFrame:
    """Per cohort: users whose activity spans at least 1, 7 and 30 days."""
    marks = (1, 7, 30)
    cohorts = activity_span(events, drop_anonymous).groupBy("cohort_date").agg(
        F.count("user_id").alias("cohort_size"),
        F.avg("days_active").alias("avg_days_active"),
        F.avg("total_events").alias("avg_events_per_user"),
        *[
            measures.count_where(F.col("days_active") >= mark).alias(f"retained_day_{mark}")
            for mark in marks
        ],
    )
    rates = {
        f"retention_day_{mark}": F.round(measures.percent(f"retained_day_{mark}", "cohort_size"), 2)
        for mark in marks
    }
    return round_columns(
        cohorts.withColumns(rates), {"avg_days_active": 2, "avg_events_per_user": 2}
    )


def _limits() -> dict[str, Column]:
    """Three-sigma bounds of a type."""
    reach = F.lit(measures.SIGMA_LIMIT) * F.col("stddev_value")
    return {"lower_bound": F.col("mean_value") - reach, "upper_bound": F.col("mean_value") + reach}


def bounded_readings(readings: DataFrame) -> DataFrame:
    """Every reading with its three-sigma bounds, side and distance in sigmas."""
    side = measures.anomaly_side("value", "lower_bound", "upper_bound")
    return with_baseline(readings).withColumns(_limits()).select(
        "*",
        side.alias("anomaly_type"),
        (side != "normal").alias("is_anomaly"),
        measures.sigma_distance("value", "mean_value", "stddev_value").alias("deviation_sigma"),
    )


def sensor_anomaly_by_location(readings: DataFrame) -> DataFrame:
    """Anomalies per sensor type and location, with the baseline of the type."""
    cells = cells_with_baseline(readings, F.col("location"), "location").withColumns(_limits())
    farthest = F.greatest(F.col("most") - F.col("mean_value"), F.col("mean_value") - F.col("least"))
    measured = {
        "avg_value": F.col("mean"),
        "max_deviation_sigma": F.try_divide(farthest, F.col("stddev_value")),
        "baseline_mean": F.col("mean_value"),
        "baseline_stddev": F.col("stddev_value"),
        "lower_threshold": F.col("lower_bound"),
        "upper_threshold": F.col("upper_bound"),
        "anomaly_rate": measures.percent("anomaly_count", "total_readings"),
    }
    rounded = [F.round(value, 2).alias(name) for name, value in measured.items()]
    return cells.select("sensor_type", "location", "total_readings", "anomaly_count", *rounded)


def stock_by_warehouse(inventory: DataFrame) -> DataFrame:
    low = F.col("quantity_on_hand") <= F.col("reorder_point")
    return inventory.groupBy("category", "warehouse").agg(
        F.count("sku").alias("total_skus"),
        F.sum("quantity_on_hand").alias("total_units_on_hand"),
        F.sum(measures.stock_value("quantity_on_hand", "unit_cost")).alias("inventory_value"),
        F.avg("unit_cost").alias("avg_unit_cost"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("orders_count").alias("orders_count"),
        measures.count_where(low).alias("items_below_reorder"),
    )


def goods_cost(transactions: DataFrame) -> DataFrame:
    """One row: the summed amount of purchases, 0 without any."""
    total = F.coalesce(F.sum("amount"), F.lit(0.0))
    return purchases(transactions).agg(total.alias("total_cogs"))


def equal_cost_share(inventory: DataFrame, transactions: DataFrame | None) -> DataFrame:
    """Stock groups with an equal share of the total cost of goods.

    Total and group count are one-value subqueries, so no frame is gathered in one task.
    """
    cost = F.lit(0.0) if transactions is None else goods_cost(transactions).scalar()
    groups = (
        inventory.select("category", "warehouse").distinct().agg(F.count("*").alias("n")).scalar()
    )
    return stock_by_warehouse(inventory).withColumn("cogs_estimate", measures.ratio(cost, groups))


def stock_turnover(inventory: DataFrame, transactions: DataFrame | None = None) -> DataFrame:
    """Turnover, days of supply and reorder alert per category and warehouse."""
    turnover = F.when(
        F.col("inventory_value") > 0, measures.ratio("cogs_estimate", "inventory_value")
    ).otherwise(F.lit(0.0))
    return equal_cost_share(inventory, transactions).select(
        "category",
        "warehouse",
        "total_skus",
        "total_units_on_hand",
        F.round("inventory_value", 2).alias("inventory_value"),
        F.round("avg_unit_cost", 2).alias("avg_unit_cost"),
        "units_sold",
        "orders_count",
        F.round(turnover, 4).alias("turnover_ratio"),
        F.round(measures.coverage_days("total_units_on_hand", "units_sold"), 1)
        .alias("days_of_supply"),
        "items_below_reorder",
        measures.is_true(F.col("items_below_reorder") > 0).alias("reorder_alert"),
    )


def with_audit(report: DataFrame, date: str) -> DataFrame:
    return stamp(report, date)
