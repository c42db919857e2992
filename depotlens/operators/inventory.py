"""Inventory analytics: demand statistics, reorder points, write-off risk and their metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.columns import (
    as_column,
    as_date,
    as_int_flag,
    clip,
    count_when,
    days_between,
    first_true,
    normal_quantile,
    resolve_column,
    to_number,
)
from depotlens.operators.forests import train_forest
from depotlens.operators.joins import lookup_default, merge_category
from depotlens.operators.ordering import running_totals
from depotlens.operators.splits import demand_split, stratified_split
from depotlens.operators.trees import node_table, score_by_nodes, with_features
from depotlens.session import settle

# Planning defaults.
DEMAND_WINDOW_DAYS = 90
LEAD_TIME_DAYS = 7.0
DEFAULT_LEAD_TIME_DAYS = 7
SERVICE_LEVEL = 0.95
LARGEST_FORECAST = 1e6
EXPIRY_HORIZON_DAYS = 30
RISK_TREES = 50
FEWEST_POSITIVES = 5

# Sales region -> store cluster.
REGION_CLUSTERS = {
    "NSW": "C1",
    "VIC": "C1",
    "QLD": "C2",
    "WA": "C2",
    "SA": "C3",
    "TAS": "C3",
    "ACT": "C1",
    "NT": "C2",
}
DEFAULT_CLUSTER = "C1"


# --- demand ------------------------------------------------------------------------------


def with_warehouse(df: DataFrame) -> DataFrame:
    """Name the stock location ``warehouse_id``, whatever the table calls it."""
    if "warehouse_id" in df.columns:
        return df
    return df.withColumn("warehouse_id", F.col(resolve_column(df, "pharmacy_id", "customer_id")))


def rolling_cutoff(df: DataFrame, date_column: str, as_of: str, days: int = DEMAND_WINDOW_DAYS) -> DataFrame:
    return df.filter(F.col(date_column) >= F.date_sub(as_date(as_of), days))


def demand_stats(
    orders: DataFrame,
    as_of: str,
    group_columns: Sequence[str] = ("product_id", "warehouse_id"),
    quantity: str = "quantity",
    date_column: str = "order_date",
    window_days: int = DEMAND_WINDOW_DAYS,
) -> DataFrame:
    """Mean and sample deviation of daily demand, over the days that had demand."""
    daily = (
        rolling_cutoff(orders, date_column, as_of, window_days)
        .groupBy(*group_columns, F.to_date(date_column).alias("_day"))
        .agg(F.sum(quantity).alias("_units"))
    )
    return (
        daily.groupBy(*group_columns)
        .agg(F.avg("_units").alias("daily_demand_mean"), F.stddev_samp("_units").alias("daily_demand_std"))
        .withColumns(
            {
                "demand_std": F.greatest(F.coalesce("daily_demand_std", F.lit(0.0)), F.lit(0.0)),
                "demand_mean": clip("daily_demand_mean", low=0),
            }
        )
    )


def demand_90d(orders: DataFrame, as_of: str, largest: float = LARGEST_FORECAST) -> DataFrame:
    """Units per product and warehouse in the window, and a 30-day forecast from them, ``largest`` at most."""
    rows = rolling_cutoff(with_warehouse(orders), "order_date", as_of)
    return (
        rows.groupBy("product_id", "warehouse_id")
        .agg(F.sum("quantity").alias("demand_90d"))
        .withColumn("forecast_demand_30d", clip(F.col("demand_90d") / 3, 0, largest))
    )


# --- replenishment -----------------------------------------------------------------------


def reorder_point(
    mean: Column | str, std: Column | str, lead_time: Column | float, service_level: float = SERVICE_LEVEL
) -> Column:
    """max(0, mean * L + z * std * sqrt(max(L, 0.1)))."""
    days = lead_time if isinstance(lead_time, Column) else F.lit(float(lead_time))
    safety = F.lit(normal_quantile(service_level)) * F.coalesce(as_column(std), F.lit(0.0))
    return F.greatest(F.lit(0.0), as_column(mean) * days + safety * F.sqrt(F.greatest(days, F.lit(0.1))))


def replenishment_recommendations(
    inventory: DataFrame,
    orders: DataFrame,
    as_of: str,
    lead_time_days: float = LEAD_TIME_DAYS,
    service_level: float = SERVICE_LEVEL,
    min_order_qty: float | None = None,
) -> DataFrame:
    """Reorder point, quantity and priority of every stock row."""
    demand = demand_stats(with_warehouse(orders), as_of)
    lead = F.lit(float(lead_time_days))
    stock = to_number("current_stock")
    quantity = F.greatest(
        F.greatest(F.col("reorder_point") - stock, F.lit(0.0)) + F.col("daily_demand_mean") * lead, F.lit(0.0)
    )
    if min_order_qty is not None:
        quantity = F.when(quantity > 0, F.greatest(quantity, F.lit(float(min_order_qty)))).otherwise(quantity)
    return (
        with_warehouse(inventory)
        .join(demand, ["product_id", "warehouse_id"], "left")
        .withColumns(
            {
                "daily_demand_mean": F.coalesce("daily_demand_mean", F.lit(0.0)),
                "demand_std": F.coalesce("demand_std", F.lit(0.0)),
                "lead_time_days": lead,
            }
        )
        .withColumn("reorder_point", reorder_point("daily_demand_mean", "demand_std", lead, service_level))
        .withColumns({"below_rop": stock < F.col("reorder_point"), "reorder_qty": quantity})
        .withColumn(
            "priority", as_int_flag(F.col("below_rop")) * 2 + as_int_flag(F.col("reorder_qty") > 0)
        )
    )


def replenishment_summary(recommendations: DataFrame) -> DataFrame:
    """One row: stock rows below their reorder point, lines to order, units to order."""
    quantity = to_number("reorder_qty")
    return recommendations.agg(
        count_when(F.col("below_rop")).alias("below_rop_count"),
        count_when(quantity > 0).alias("reorder_lines"),
        F.coalesce(F.sum(quantity), F.lit(0.0)).alias("total_reorder_qty"),
    )


# --- write-off risk ----------------------------------------------------------------------


def writeoff_features(
    inventory: DataFrame, as_of: str, orders: DataFrame | None = None, products: DataFrame | None = None
) -> DataFrame:
    """Days to expiry, stock share, demand proxy, turnover, month and category of each stock row."""
    rows = with_warehouse(inventory)
    if "days_until_expiry" in rows.columns:
        days = rows["days_until_expiry"].try_cast("bigint")
    elif "expiry_date" in rows.columns:
        days = days_between(as_date(as_of), F.col("expiry_date"))
    else:
        days = F.lit(None).cast("bigint")
    stock = to_number("current_stock") if "current_stock" in rows.columns else F.lit(0.0)
    full = F.col("max_stock").try_cast("double") if "max_stock" in rows.columns else F.lit(1.0)
    share = F.try_divide(stock, F.when(full == 0, F.lit(1.0)).otherwise(full))
    rows = rows.withColumns({"days_until_expiry": days, "stock_pct": clip(share, 0, 1)})
    if orders is not None:
        forecast = demand_90d(orders, as_of).drop("demand_90d")
        rows = rows.join(forecast, ["product_id", "warehouse_id"], "left")
    else:
        rows = rows.withColumn("forecast_demand_30d", F.lit(None).cast("double"))
    rows = rows.withColumn("forecast_demand_30d", F.coalesce("forecast_demand_30d", F.lit(0.0))).withColumns(
        {
            "turnover_rate": F.col("forecast_demand_30d") * 3 / (stock + 1),
            "month": F.month(as_date(as_of)).cast("bigint"),
        }
    )
    if products is not None:
        rows = merge_category(rows, products, resolve_column(products, "therapeutic_category", "category"))
    return rows


def expiry_label(days: Column | str = "days_until_expiry", horizon: int = EXPIRY_HORIZON_DAYS) -> Column:
    return as_int_flag(as_column(days).between(0, horizon))


# Feature order, and the columns a label is made from.
# One row per column: its use, and the labels that are made from it.
RISK_COLUMNS = (
    ("current_stock", "number", ""),
    ("stock_pct", "number", ""),
    ("forecast_demand_30d", "number", ""),
    ("turnover_rate", "number", ""),
    ("month", "number", ""),
    ("therapeutic_category", "category", ""),
    ("category", "category", ""),
    ("days_until_expiry", "source", "will_expire_30d"),
)


def leak_guard(columns: Sequence[str], label: str = "will_expire_30d") -> list[str]:
    """Columns that do not tell the label."""
    telling = {name for name, _, labels in RISK_COLUMNS if label in labels.split()}
    return [c for c in columns if c not in telling]


def risk_feature_columns(df: DataFrame, label: str = "will_expire_30d") -> list[str]:
    return leak_guard([name for name, use, _ in RISK_COLUMNS if use != "source" and name in df.columns], label)


def _cleaned(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit("")) if kinds[c] == "string" else to_number(c)
            for c in columns
        }
    )


def train_writeoff_classifier(
    features: DataFrame,
    label: str = "will_expire_30d",
    holdout: float = 0.2,
    seed: int = 42,
    id_columns: list[str] | None = None,
    trees: int = RISK_TREES,
) -> tuple[PipelineModel, list[str], DataFrame]:
    """Fit a forest on a stratified split; returns model, feature columns and holdout metrics.

    Gaps in features are filled as in prediction; rows without a label are left out. Categories are codes in
    name order and enter as plain numbers, so there may be any number of them. Fewer than five positive
    labels are an error.
    """
    columns = risk_feature_columns(features, label)
    if not columns:
        raise ValueError("no feature column is left without those the label is made from")
    rows = features.dropna(subset=[label])
    positives = rows.filter(F.col(label) == 1).limit(FEWEST_POSITIVES).count()
    if positives < FEWEST_POSITIVES:
        raise ValueError(f"{positives} rows with a positive {label}, at least {FEWEST_POSITIVES} are needed")
    rows = _cleaned(rows, columns)
    train, held = stratified_split(rows, label, holdout, seed, id_columns)
    # Only what the trees read, once: quantiles, codes and cells all ask for it.
    train = settle(train.select(label, *columns))
    words = [c for c in columns if dict(rows.dtypes)[c] == "string"]
    coded = [f"{c}_code" for c in words]
    stages = []
    if words:
        stages.append(
            StringIndexer(
                inputCols=words, outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="keep"
            )
        )
        # Arithmetic drops the mark of a nominal column, which would need a bin for each category.
        plain = ", ".join(f"{c} + 0.0D AS {c}_number" for c in coded)
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
    prepared = Pipeline(stages=stages).fit(train)
    numbers = [*(f"{c}_number" for c in coded), *(c for c in columns if c not in words)]
    model = train_forest(prepared.transform(train), prepared.stages, numbers, label, trees, seed)
    scored = settle(
        predict_writeoff_risk(model, held, columns).select(
            F.col(label).cast("bigint").alias("actual"),
            F.col("prediction").cast("bigint").alias("predicted"),
            "risk_score",
        )
    )
    return model, columns, classification_metrics(scored, "actual", "predicted", "risk_score")


def predict_writeoff_risk(model: PipelineModel, features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``risk_score``, the probability of class 1."""
    scored = model.transform(_cleaned(features, columns))
    keep = [*features.columns, "prediction"]
    return scored.withColumn("risk_score", vector_to_array("probability")[1]).select(*keep, "risk_score")


def risk_by_nodes(model: PipelineModel, features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``node_score``: the probability of class 1 as it follows from the forest's table of nodes."""
    rows = with_features(model, _cleaned(features, columns))
    scored = score_by_nodes(rows, node_table(features.sparkSession, model), mean=True)
    return scored.select(*features.columns, "node_score")


# --- metrics -----------------------------------------------------------------------------


def cumulative_pr(scored: DataFrame, actual: str, score: str) -> DataFrame:
    """Precision and recall at every distinct score, highest first."""
    per_score = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(actual).cast("bigint")).alias("positives")
    )
    totals = per_score.agg(F.sum("positives").alias("all_positives"))
    swept = running_totals(per_score, [F.col("threshold").desc()], "rows", "positives")
    return swept.select(
        "threshold",
        "rows",
        "positives",
        F.try_divide(F.col("running_positives").cast("double"), F.col("running_rows").cast("double")).alias(
            "precision"
        ),
        F.coalesce(
            F.try_divide(F.col("running_positives").cast("double"), totals.scalar().cast("double")),
            F.lit(0.0),
        ).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("positives").cast("double"), totals.scalar().cast("double")), F.lit(0.0)
        ).alias("recall_step"),
    )


def average_precision(scored: DataFrame, actual: str, score: str) -> DataFrame:
    """Sum of precision times the recall gained, over distinct scores."""
    steps = cumulative_pr(scored, actual, score)
    return steps.agg(
        F.coalesce(F.sum(F.col("recall_step") * F.col("precision")), F.lit(0.0)).alias("pr_auc")
    )


def classification_metrics(
    scored: DataFrame, actual: str, predicted: str, score: str | None = None
) -> DataFrame:
    """One row: accuracy, F1, precision, recall, share of positives and average precision."""
    truth, guess = F.col(actual) == 1, F.col(predicted) == 1
    counts = scored.agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        count_when(truth & guess).cast("double").alias("_tp"),
        count_when(~truth & guess).cast("double").alias("_fp"),
        count_when(truth & ~guess).cast("double").alias("_fn"),
        count_when(F.col(actual) == F.col(predicted)).cast("double").alias("_same"),
    )

    def share(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    out = counts.select(
        share(F.col("_same"), F.col("_n")).alias("accuracy"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(tp + fn, F.col("_n")).alias("positive_rate"),
    )
    if score is not None:
        out = out.withColumn("pr_auc", average_precision(scored, actual, score).scalar())
    return out


def forecast_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: MAE, RMSE and MAPE in per cent over rows with a positive actual; zeros if none."""
    seen, guess = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = F.when((seen > 0) & guess.isNotNull(), seen - guess)
    return df.agg(
        F.coalesce(F.avg(F.abs(error)), F.lit(0.0)).alias("mae"),
        F.coalesce(F.sqrt(F.avg(error * error)), F.lit(0.0)).alias("rmse"),
        F.coalesce(F.avg(F.abs(F.try_divide(error, seen))) * 100, F.lit(0.0)).alias("mape"),
    )


def naive_mean_forecast(
    orders: DataFrame,
    target: str = "quantity",
    time_column: str = "order_date",
    fraction: float = 0.2,
    tie_columns: list[str] | None = None,
) -> DataFrame:
    """Error of the training mean as the forecast of the later rows."""
    early, late = demand_split(orders, fraction, time_column, tie_columns)
    baseline = early.agg(F.avg(to_number(target)).alias("mean"))
    judged = late.select(to_number(target).alias("actual"), baseline.scalar().alias("predicted"))
    return forecast_metrics(judged, "actual", "predicted")


# --- derived tables ----------------------------------------------------------------------


def inventory_availability(inventory: DataFrame, products: DataFrame, snapshot: str) -> DataFrame:
    """Stock per product and warehouse with the product's lead time and supplier."""
    stock = (
        with_warehouse(inventory)
        .groupBy("product_id", "warehouse_id")
        .agg(F.sum("current_stock").alias("quantity_available"))
    )
    with_lead = lookup_default(stock, products, "product_id", "lead_time_days", DEFAULT_LEAD_TIME_DAYS)
    suppliers = products.groupBy("product_id").agg(F.min("supplier_id").alias("supplier_id"))
    return with_lead.join(suppliers, "product_id", "left").select(
        "product_id",
        "warehouse_id",
        "quantity_available",
        F.col("lead_time_days").cast("bigint").alias("lead_time_days"),
        "supplier_id",
        as_date(snapshot).alias("snapshot_date"),
    )


def expiry_batches(inventory: DataFrame) -> DataFrame:
    moved = F.col("movement_quantity") if "movement_quantity" in inventory.columns else F.col("current_stock")
    return inventory.select(
        F.col("batch_number").alias("batch_id"),
        "product_id",
        F.col("pharmacy_id").alias("warehouse_id"),
        "expiry_date",
        F.col("current_stock").alias("quantity"),
        (F.col("cost_per_unit") * moved).alias("cost_basis"),
    )


def warehouses_from_pharmacies(pharmacies: DataFrame) -> DataFrame:
    return pharmacies.select(
        F.col("pharmacy_id").alias("warehouse_id"),
        F.concat("name", F.lit(" (Warehouse)")).alias("name"),
        F.col("state").alias("region"),
    )


def region_cluster(region: Column | str) -> Column:
    subject = as_column(region)
    return first_true([(subject == state, cluster) for state, cluster in REGION_CLUSTERS.items()], DEFAULT_CLUSTER)


def store_attributes_from_pharmacies(pharmacies: DataFrame, size: Column | None = None) -> DataFrame:
    return pharmacies.select(
        F.col("pharmacy_id").alias("store_id"),
        F.col("address").alias("location"),
        F.col("state").alias("region"),
        (size if size is not None else F.lit(None)).cast("bigint").alias("size_sqm"),
        F.lit("pharmacy").alias("store_type"),
        region_cluster("state").alias("cluster_id"),
    )
