"""Checks of ordering, inventory and recommendation operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.feeds_sql import AS_OF, CTE, query, rnd
from checks.medallion import layers
from depotlens.operators import groupwise, inventory, ordering, recommend, splits
from depotlens.operators.gold import inventory_features
from depotlens.operators.neighbours import item_knn_cosine, standardize
from depotlens.operators.trees import node_table, score_by_nodes, with_features
from depotlens.plans import recommendation as flows
from depotlens.session import settle
from depotlens.sources.star_schema import AS_OF as TODAY


def _rounded(df, scale, *columns):
    return df.withColumns({c: F.round(c, scale) for c in columns})


# --- inventory ---------------------------------------------------------------------------


def _site_demand(feeds):
    """Sales of each stock location as demand."""
    return feeds.store_sales.select(
        "product_id",
        F.col("store_id").alias("warehouse_id"),
        F.col("date").alias("order_date"),
        F.col("sales_quantity").alias("quantity"),
    )


CTE["demand_table"] = f"""
SELECT product_id, warehouse_id, avg(units) AS daily_demand_mean, stddev_samp(units) AS daily_demand_std,
  greatest(coalesce(stddev_samp(units), 0), 0) AS demand_std, greatest(avg(units), 0) AS demand_mean
FROM (SELECT product_id, store_id AS warehouse_id, date, sum(sales_quantity) AS units FROM raw_store_sales
  WHERE date >= {AS_OF} - INTERVAL 90 DAY GROUP BY ALL) GROUP BY product_id, warehouse_id"""

CTE["replenishment_table"] = """
SELECT *, CASE WHEN plain_qty > 0 THEN greatest(plain_qty, 12) ELSE plain_qty END AS reorder_qty
FROM (SELECT inventory_id, product_id, pharmacy_id, warehouse_id, current_stock, reorder_point,
    current_stock < reorder_point AS below_rop,
    greatest(greatest(reorder_point - current_stock, 0) + mean * 7, 0) AS plain_qty
  FROM (SELECT inventory_id, i.product_id, pharmacy_id, pharmacy_id AS warehouse_id, current_stock,
      coalesce(daily_demand_mean, 0) AS mean,
      greatest(0, coalesce(daily_demand_mean, 0) * 7 + 1.6448536269514715::DOUBLE * coalesce(demand_std, 0) * sqrt(7.0::DOUBLE)) AS reorder_point
    FROM silver_inventory i LEFT JOIN demand_table d ON i.product_id = d.product_id AND i.pharmacy_id = d.warehouse_id))"""


def _replenishment(feeds):
    return inventory.replenishment_recommendations(
        layers(feeds).inventory, _site_demand(feeds), TODAY, min_order_qty=12
    )


CTE["demand_90_table"] = f"""
SELECT product_id, customer_id AS warehouse_id, CAST(sum(quantity) AS BIGINT) AS demand_90d,
  least(greatest(CAST(sum(quantity) AS DOUBLE) / 3, 0), 1e6) AS forecast_demand_30d
FROM silver_orders WHERE order_date >= {AS_OF} - INTERVAL 90 DAY GROUP BY ALL"""

CTE["site_forecast"] = f"""
SELECT product_id, store_id AS warehouse_id, least(greatest(CAST(sum(sales_quantity) AS DOUBLE) / 3, 0), 1e6) AS forecast_demand_30d
FROM raw_store_sales WHERE date >= {AS_OF} - INTERVAL 90 DAY GROUP BY ALL"""

CTE["risk_table"] = """
SELECT inventory_id, i.product_id, pharmacy_id, current_stock, days_until_expiry,
  least(greatest(current_stock / CASE WHEN max_stock = 0 THEN 1 ELSE max_stock END, 0), 1) AS stock_pct,
  coalesce(forecast_demand_30d, 0) AS forecast_demand_30d,
  coalesce(forecast_demand_30d, 0) * 3 / (current_stock + 1) AS turnover_rate, CAST(8 AS BIGINT) AS month,
  coalesce(therapeutic_category, 'unknown') AS therapeutic_category,
  CAST(CASE WHEN days_until_expiry BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS BIGINT) AS will_expire_30d
FROM silver_inventory i LEFT JOIN site_forecast d ON i.product_id = d.product_id AND i.pharmacy_id = d.warehouse_id
  LEFT JOIN silver_products p ON i.product_id = p.product_id"""


def _risk_features(feeds):
    lake = layers(feeds)
    rows = inventory.writeoff_features(lake.inventory, TODAY, _site_demand(feeds), lake.products)
    return rows.withColumn("will_expire_30d", inventory.expiry_label()).select(
        "inventory_id",
        "product_id",
        "pharmacy_id",
        "current_stock",
        "days_until_expiry",
        "stock_pct",
        "forecast_demand_30d",
        "turnover_rate",
        "month",
        "therapeutic_category",
        "will_expire_30d",
    )


CTE["scored_docs"] = """
SELECT quality AS actual, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS predicted, CAST(n_chars AS DOUBLE) AS score
FROM labels JOIN documents USING (doc_id)"""


def _scored_docs(feeds):
    return feeds.table("labels").join(feeds.table("documents"), "doc_id").select(
        F.col("quality").cast("bigint").alias("actual"),
        (F.col("n_chars") >= 1000).cast("bigint").alias("predicted"),
        F.col("n_chars").cast("double").alias("score"),
    )


CTE["pr_steps"] = """
SELECT threshold, rows, positives, CAST(run_pos AS DOUBLE) / run_rows AS precision,
  CAST(run_pos AS DOUBLE) / total AS recall, CAST(positives AS DOUBLE) / total AS recall_step
FROM (SELECT *, sum(positives) OVER (ORDER BY threshold DESC) AS run_pos, sum(rows) OVER (ORDER BY threshold DESC) AS run_rows,
    sum(positives) OVER () AS total
  FROM (SELECT score AS threshold, count(*) AS rows, CAST(sum(actual) AS BIGINT) AS positives FROM scored_docs GROUP BY score))"""

CTE["confusion"] = """
SELECT count(*)::DOUBLE AS n, count(CASE WHEN actual = 1 AND predicted = 1 THEN 1 END)::DOUBLE AS tp,
  count(CASE WHEN actual = 0 AND predicted = 1 THEN 1 END)::DOUBLE AS fp,
  count(CASE WHEN actual = 1 AND predicted = 0 THEN 1 END)::DOUBLE AS fn FROM scored_docs"""

CTE["ordered_demand"] = """
SELECT CAST(quantity AS DOUBLE) AS q, row_number() OVER (ORDER BY order_date, md5('split|' || order_id || '|' || product_id || '|' || quantity || '|' || total_amount)) AS rn,
  count(*) OVER () AS n FROM raw_orders"""

FORECAST = """
SELECT round(avg(abs(q - m)), 6) AS mae, round(sqrt(avg((q - m) * (q - m))), 6) AS rmse, round(avg(abs(q - m) / q) * 100, 6) AS mape
FROM (SELECT q, (SELECT avg(q) FROM ordered_demand WHERE rn <= greatest(1, floor(n * (1 - 0.2::DOUBLE)))) AS m
  FROM ordered_demand WHERE rn > greatest(1, floor(n * (1 - 0.2::DOUBLE)))) WHERE q > 0"""


def _forecast(feeds):
    ties = ["order_id", "product_id", "quantity", "total_amount"]
    return _rounded(
        inventory.naive_mean_forecast(feeds.orders, tie_columns=ties), 6, "mae", "rmse", "mape"
    )


def _strata(feeds):
    train, held = splits.stratified_split(feeds.table("labels"), "toxic", 0.2, 42, ["doc_id"])
    return train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("holdout")))


# --- recommendation ----------------------------------------------------------------------

CTE["ordered_interactions"] = """
SELECT *, row_number() OVER (ORDER BY interaction_timestamp, md5('split|' || interaction_id)) AS rn, count(*) OVER () AS n
FROM silver_interactions"""
CTE["train_rows"] = "SELECT * FROM ordered_interactions WHERE rn <= greatest(1, floor(n * (1 - 0.2::DOUBLE)))"
CTE["validation_rows"] = "SELECT * FROM ordered_interactions WHERE rn > greatest(1, floor(n * (1 - 0.2::DOUBLE)))"
CTE["truth_table"] = """
SELECT DISTINCT CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id
FROM validation_rows WHERE action_type = 'purchased'"""
CTE["base_table"] = """
SELECT customer_id, product_id, CAST(max(CASE WHEN action_type = 'purchased' THEN 1 ELSE 0 END) AS BIGINT) AS label,
  max(interaction_timestamp) AS last_interaction_timestamp, count(*) AS interaction_count
FROM silver_interactions GROUP BY customer_id, product_id"""
CTE["weight_table"] = f"""
SELECT customer_id, product_id, {rnd("sum(CASE action_type WHEN 'purchased' THEN 1.0::DOUBLE WHEN 'added' THEN 0.5::DOUBLE WHEN 'viewed' THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END)", 1)} AS weight
FROM silver_interactions GROUP BY customer_id, product_id"""
CTE["last_items"] = """
SELECT customer_id, product_id AS anchor_product_id FROM train_rows
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY interaction_timestamp DESC, product_id DESC) = 1"""
CTE["feature_matrix"] = """
SELECT product_id, CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS category_enc,
  CAST(dense_rank() OVER (ORDER BY therapeutic_category) - 1 AS DOUBLE) AS therapeutic_category_enc,
  CAST(dense_rank() OVER (ORDER BY price_tier) - 1 AS DOUBLE) AS price_tier_enc,
  CAST(dense_rank() OVER (ORDER BY regulatory_class) - 1 AS DOUBLE) AS regulatory_class_enc,
  unit_price, margin_percentage, CAST(CAST(is_prescription AS INT) AS DOUBLE) AS is_prescription
FROM silver_products"""

MATRIX = (
    "category_enc",
    "therapeutic_category_enc",
    "price_tier_enc",
    "regulatory_class_enc",
    "unit_price",
    "margin_percentage",
    "is_prescription",
)


def _scaled(column: str) -> str:
    spread = f"stddev_pop({column}) OVER ()"
    return (
        f"({column} - avg({column}) OVER ()) / "
        f"CASE WHEN {spread} <= 1e-12 * greatest(1, abs(avg({column}) OVER ())) THEN 1 ELSE {spread} END AS {column}"
    )


CTE["scaled_matrix"] = f"SELECT product_id, {', '.join(_scaled(c) for c in MATRIX)} FROM feature_matrix"
CTE["product_vectors"] = f"""
SELECT product_id AS id, [x / sqrt(list_inner_product(v, v)) for x in v] AS u
FROM (SELECT product_id, [{', '.join(MATRIX)}] AS v FROM scaled_matrix)"""
CTE["embedding_vectors"] = """
SELECT vec_id AS id, [x / sqrt(list_inner_product(v, v)) for x in v] AS u
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def _nearest(source: str) -> str:
    return f"""
SELECT a.id AS product_id, b.id AS similar_product_id, round(1 - list_inner_product(a.u, b.u), 9) + 0.0 AS similarity_score,
  row_number() OVER (PARTITION BY a.id ORDER BY round(1 - list_inner_product(a.u, b.u), 9), b.id) AS rank
FROM {source} a JOIN {source} b ON a.id <> b.id QUALIFY rank <= 10"""


CTE["similar_products"] = _nearest("product_vectors")
CTE["similar_embeddings"] = _nearest("embedding_vectors")
CTE["anchor_lists"] = """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(similar_product_id AS VARCHAR) AS product_id, rank
FROM last_items JOIN similar_products ON anchor_product_id = similar_products.product_id
WHERE CAST(customer_id AS VARCHAR) IN (SELECT customer_id FROM truth_table)"""

# Predictions that SQL reaches as well: the ten best-selling training products, for every customer.
CTE["best_sellers"] = """
SELECT product_id, row_number() OVER (ORDER BY count(*) DESC, product_id) AS rank FROM train_rows
GROUP BY product_id QUALIFY rank <= 10"""
CTE["customer_top"] = """
SELECT customer_id, product_id, count(*) AS score,
  row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_id) AS rank
FROM train_rows GROUP BY customer_id, product_id QUALIFY rank <= 10"""
def _user_metrics_sql(k: int, source: str = "customer_top") -> str:
    return f"""
SELECT t.customer_id, coalesce(hits, 0) / {k}.0::DOUBLE AS precision_at_k, coalesce(hits, 0) / relevant AS recall_at_k,
  coalesce(dcg, 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, CAST(least(relevant, {k}) AS BIGINT) + 1) r(i)) AS ndcg_at_k
FROM (SELECT customer_id, CAST(count(*) AS DOUBLE) AS relevant FROM truth_table GROUP BY 1) t
  JOIN (SELECT p.customer_id, CAST(count(t.product_id) AS DOUBLE) AS hits,
      sum(CASE WHEN t.product_id IS NOT NULL THEN 1 / log2(rank + 1) END) AS dcg
    FROM (SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id, rank FROM {source}
      WHERE rank <= {k}) p
    LEFT JOIN truth_table t ON t.customer_id = p.customer_id AND t.product_id = p.product_id GROUP BY 1) h
  ON t.customer_id = h.customer_id"""


CTE["user_metrics"] = _user_metrics_sql(10)
CTE["user_metrics_3"] = _user_metrics_sql(3)
CTE["anchor_metrics"] = _user_metrics_sql(10, "anchor_lists")


def _split(feeds):
    return flows.split_events(layers(feeds).interactions)


def _customer_top(train):
    counts = train.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("score"))
    return ordering.topk_per_group(
        counts, "customer_id", 10, F.col("score").desc(), F.col("product_id"), rank="rank"
    )


def _user_metrics(feeds):
    train, later = _split(feeds)
    return recommend.ranking_metrics_per_user(_customer_top(train), recommend.purchases_truth(later))


def _metrics(feeds):
    train, later = _split(feeds)
    return recommend.evaluate_recommendations(_customer_top(train), recommend.purchases_truth(later))


def _split_sides(feeds):
    train, later = _split(feeds)
    return (
        train.select("interaction_id", F.lit("train").alias("part"))
        .unionByName(later.select("interaction_id", F.lit("validation").alias("part")))
    )


def _anchors(feeds):
    train, later = _split(feeds)
    neighbours = recommend.item_similarity(layers(feeds).products)
    return recommend.anchor_recommendations(train, recommend.purchases_truth(later), neighbours)


def _standardized(feeds):
    matrix = recommend.product_features_matrix(layers(feeds).products)
    return _rounded(standardize(matrix, *MATRIX), 6, *MATRIX)


def _similar_embeddings(feeds, **options):
    return item_knn_cosine(
        feeds.table("embeddings").select(F.col("vec_id").alias("product_id"), F.col("embedding").alias("features")), **options
    )


CTE["draws"] = """
SELECT customer_id, positive_product_id, n_free, slot, CASE WHEN slot = 1 AND r1 >= r0 THEN r1 + 1 WHEN slot = 1 THEN r1 ELSE r0 END AS r
FROM (SELECT customer_id, product_id AS positive_product_id, n_free, slot,
    CAST('0x' || left(md5('42|' || customer_id || '|' || product_id || '|0'), 8) AS BIGINT) % n_free AS r0,
    CASE WHEN n_free > 1 THEN CAST('0x' || left(md5('42|' || customer_id || '|' || product_id || '|1'), 8) AS BIGINT) % (n_free - 1) END AS r1
  FROM base_table JOIN free_counts USING (customer_id) CROSS JOIN (SELECT unnest([0, 1]) AS slot) WHERE label = 1)
WHERE slot < n_free"""
CTE["bought_table"] = "SELECT customer_id, product_id FROM base_table WHERE label = 1"
CTE["free_counts"] = """
SELECT customer_id, count(*) AS n_bought, (SELECT count(*) FROM silver_products) - count(*) AS n_free
FROM bought_table WHERE product_id IN (SELECT product_id FROM silver_products) GROUP BY customer_id"""
CTE["free_products"] = """
SELECT c.customer_id, p.product_id, row_number() OVER (PARTITION BY c.customer_id ORDER BY p.product_id) - 1 AS r
FROM (SELECT DISTINCT customer_id FROM bought_table) c CROSS JOIN silver_products p
  LEFT JOIN bought_table b ON b.customer_id = c.customer_id AND b.product_id = p.product_id WHERE b.product_id IS NULL"""
CTE["negative_table"] = """
SELECT d.customer_id, f.product_id, CAST(0 AS BIGINT) AS label, positive_product_id, CAST(slot AS BIGINT) AS slot
FROM draws d JOIN free_products f ON d.customer_id = f.customer_id AND d.r = f.r"""


def _base(feeds):
    return recommend.training_base(layers(feeds).interactions)


def _negatives(feeds):
    return recommend.negative_samples(_base(feeds), layers(feeds).products)


def _factors(feeds):
    """The given vectors in 64ths as factors of users and of items: inner products are whole numbers."""
    whole = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("float"))
    return feeds.table("embeddings").select(F.col("vec_id").alias("id"), whole.alias("features"))


def _factor_lists(feeds, seen=None):
    factors = _factors(feeds)
    found = recommend.recommend_from_factors(factors, factors, 10, seen)
    return found.withColumn("score", F.col("score").cast("bigint"))


def _pairs_seen(feeds):
    return layers(feeds).interactions.select("customer_id", "product_id")


FACTOR_LISTS = """
SELECT customer_id, product_id, CAST(score AS BIGINT) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, product_id) AS rank FROM (
    SELECT u.vec_id AS customer_id, i.vec_id AS product_id, list_inner_product(u.v, i.v) AS score FROM vectors u, vectors i {0}))
WHERE rank <= 10"""
CTE["vectors"] = "SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings"
CTE["seen_pairs"] = "SELECT DISTINCT customer_id, product_id FROM silver_interactions"
UNSEEN = "LEFT JOIN seen_pairs s ON s.customer_id = u.vec_id AND s.product_id = i.vec_id WHERE s.product_id IS NULL"


def _list_facts(found, key="customer_id"):
    """Per user: length of the list, whether ranks run from 1 and scores fall."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "score", "product_id")))
    rows = found.groupBy(key).agg(entries.alias("e"))
    falls = F.forall(F.sequence(F.lit(1), F.size("e") - 1), lambda i: F.get("e", i - 1)["score"] >= F.get("e", i)["score"])
    return rows.select(
        key,
        F.size("e").cast("bigint").alias("n"),
        (F.size(F.array_distinct("e.product_id")) == F.size("e")).alias("distinct_items"),
        (F.col("e.rank") == F.sequence(F.lit(1), F.size("e"))).alias("ranks_run"),
        ((F.size("e") < 2) | falls).alias("scores_fall"),
    )


def _fitted_als(feeds, iterations=10):
    weights, _ = flows.coded(settle(recommend.interaction_weights(layers(feeds).interactions)))
    weights = settle(weights)
    return recommend.als_implicit(weights, 32, iterations), weights


def _als_solved(feeds):
    """Every user, and whether its factors solve its normal equations."""
    found = recommend.als_residuals(*_fitted_als(feeds))
    return found.select("customer_id", "n_items", (F.col("residual") < 1e-3).alias("solved"))


def _als_loss(feeds):
    """Whether the loss falls with the iterations and from zero factors."""
    long, short = (recommend.als_objective(*_fitted_als(feeds, n)) for n in (10, 1))
    return long.select(
        (F.col("objective") < short.select("objective").scalar()).alias("falls"), (F.col("objective") < F.col("at_zero")).alias("below_zero_factors")
    )


def _als_recommendations(feeds):
    interactions = layers(feeds).interactions
    found = flows.factor_recommendations(interactions)
    new = found.join(interactions, ["customer_id", "product_id"], "left_anti")
    return _list_facts(new)


def _als_all_items(feeds):
    return _list_facts(flows.factor_recommendations(layers(feeds).interactions, filter_seen=False))


FACTS = "true AS distinct_items, true AS ranks_run, true AS scores_fall"
LIST_FACTS = f"""
SELECT customer_id, least(10, (SELECT count(DISTINCT product_id) FROM silver_interactions){{0}})::BIGINT AS n, {FACTS}
FROM silver_interactions GROUP BY customer_id"""


def _fitted_risk(feeds):
    lake = layers(feeds)
    rows = inventory.writeoff_features(lake.inventory, TODAY, _site_demand(feeds), lake.products)
    # Only what training and scoring read is carried through the joins and written.
    rows = rows.withColumn("will_expire_30d", inventory.expiry_label())
    rows = settle(rows.select("inventory_id", "will_expire_30d", *inventory.risk_feature_columns(rows)))
    return rows, *inventory.train_writeoff_classifier(rows, id_columns=["inventory_id"])


def _same(one, other):
    return F.abs(F.col(one) - F.col(other)) < 1e-9


def _risk_rows(feeds):
    """Every stock row with its label, and whether its score is the one that the forest's node table gives."""
    rows, model, columns, _ = _fitted_risk(feeds)
    scored = inventory.risk_by_nodes(model, inventory.predict_writeoff_risk(model, rows, columns), columns)
    return scored.select(
        "inventory_id",
        "will_expire_30d",
        F.col("risk_score").between(0, 1).alias("is_probability"),
        _same("risk_score", "node_score").alias("equals_nodes"),
    )


def _risk_metrics(feeds):
    """The holdout keeps the share of each class; the metrics follow from node scores of its rows, counted anew."""
    rows, model, columns, metrics = _fitted_risk(feeds)
    held = splits.stratified_split(rows, "will_expire_30d", 0.2, 42, ["inventory_id"])[1]
    scored = settle(inventory.risk_by_nodes(model, held, columns).select(F.col("will_expire_30d").alias("y"), F.col("node_score").alias("p")))
    guess = (F.col("p") > 0.5).cast("int")
    counts = scored.agg(
        F.avg((guess == F.col("y")).cast("double")).alias("a"),
        F.try_divide(2 * F.sum(guess * F.col("y")), F.sum(guess) + F.sum("y")).alias("f"),
        F.try_divide(F.sum(guess * F.col("y")).cast("double"), F.sum(guess).cast("double")).alias("q"),
        F.try_divide(F.sum(guess * F.col("y")).cast("double"), F.sum("y").cast("double")).alias("r"),
    )
    # Average precision once more, as the mean over positives of the precision at their own score.
    positives = scored.where("y = 1").select(F.round("p", 12).alias("at"))
    steps = scored.groupBy(F.round("p", 12).alias("at")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("k"))
    below = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    precision = steps.select("at", (F.sum("k").over(below) / F.sum("n").over(below)).alias("v"))
    area = positives.join(precision, "at").agg(F.avg("v").alias("area"))
    pairs = {"accuracy": "a", "f1": "f", "precision": "q", "recall": "r", "pr_auc": "area"}
    anew, average = counts.select(F.struct("*").alias("own")).scalar(), area.scalar()  # one row each
    both = metrics.select("*", *[anew[c].alias(c) for c in counts.columns], average.alias("area")).na.fill(0.0)
    return both.select(
        F.round("positive_rate", 9).alias("positive_rate"), *[_same(name, own).alias(f"{name}_is_own") for name, own in pairs.items()]
    )


# Product columns by the way in which they become numbers.
PRODUCT_WORDS = (
    "pbs_code atc_code active_ingredient dosage_form pack_size therapeutic_category brand generic_equivalent_id pack_size_variants "
    "product_name generic_name category manufacturer supplier storage_type price_tier storage_classification regulatory_class silver_model_name"
).split()
PRODUCT_FLAGS = (
    "is_prescription is_controlled_substance requires_cold_chain has_negative_unit_price has_negative_wholesale_price "
    "has_negative_retail_price has_negative_expiry_months has_future_created_date"
).split()
PRODUCT_DATES = ["created_date", "last_updated"]
PRODUCT_AMOUNTS = (
    "expiry_months batch_size minimum_order_quantity lead_time_days supplier_id margin_percentage unit_price wholesale_price retail_price "
    "profit_margin profit_margin_percentage days_since_created"
).split()
PRODUCT_AS_NUMBERS = (
    {c: f"dense_rank() OVER (ORDER BY coalesce({c}, '')) - 1" for c in PRODUCT_WORDS}
    | {c: f"CAST({c} AS INTEGER)" for c in PRODUCT_FLAGS}
    | {c: f"date_diff('day', DATE '1970-01-01', {c})" for c in PRODUCT_DATES}
    | {c: c for c in PRODUCT_AMOUNTS}
)
RANKER_ROWS = f"""
SELECT b.customer_id, b.product_id, label, CAST(interaction_count AS DOUBLE) AS interaction_count,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in PRODUCT_AS_NUMBERS)}
FROM base_table b LEFT JOIN (
  SELECT product_id, {", ".join(f"CAST({sql} AS DOUBLE) AS {c}" for c, sql in PRODUCT_AS_NUMBERS.items())} FROM silver_products) p
  ON b.product_id = p.product_id"""


def _ranked(feeds):
    return _list_facts(flows.ranker_recommendations(_base(feeds), layers(feeds).products))


def _ranker_scores(feeds):
    """Every pair with history, and whether the ranker's score is the one that its node table gives."""
    base, products = settle(_base(feeds)), settle(layers(feeds).products)
    rows, columns = recommend.ranker_features(recommend.like_pairs(base, "label"), products)
    model = recommend.train_ranker(settle(rows), columns, iterations=5)
    rows = settle(recommend.ranker_features(recommend.like_pairs(base), products)[0])
    scored = score_by_nodes(with_features(model, model.transform(rows).drop("_features")), node_table(feeds.spark, model))
    found = recommend.of_each_pair(base, scored, "score", "node_score")
    return found.select("customer_id", "product_id", _same("score", "node_score").alias("equals_nodes"))


GROUP_COLUMNS = ("interaction_count", "unit_price", "margin_percentage", "lead_time_days")


def _group_ranked(feeds):
    """Best five pairs of every customer by the published weights, which are recomputed from them in another way."""
    rows, _ = recommend.ranker_features(_base(feeds), layers(feeds).products)
    rows = settle(rows.select("customer_id", "product_id", "label", *GROUP_COLUMNS))
    weights = settle(groupwise.train_group_ranker(rows, GROUP_COLUMNS))
    ranked = groupwise.rank_in_groups(weights, rows, 5)
    parts = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in GROUP_COLUMNS]
    long = rows.select("customer_id", "product_id", F.explode(F.array(*parts)).alias("e")).select("customer_id", "product_id", "e.*")
    again = long.join(weights, "feature").groupBy("customer_id", "product_id").agg(F.sum(F.col("x") * F.col("weight")).alias("again"))
    # Ranks without ties that rounding may turn: each score is the sum, and none below it is larger.
    near = F.abs(F.col("score") - F.col("again")) <= 1e-9 * (1 + F.abs(F.col("again")))
    return (
        ranked.join(again, ["customer_id", "product_id"])
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.every(near).alias("scores_recomputed"))
    )


def _ranker_rows(feeds):
    rows, _ = recommend.ranker_features(_base(feeds), layers(feeds).products)
    return rows.drop("last_interaction_timestamp")


def _compared(feeds):
    train, later = _split(feeds)
    truth = recommend.purchases_truth(later)
    own = _customer_top(train)
    short = own.filter(F.col("rank") <= 3)
    return recommend.compare_models(
        {
            "own_ten": _rounded_metrics(recommend.evaluate_recommendations(own, truth)),
            "own_three": _rounded_metrics(recommend.evaluate_recommendations(short, truth, 3)),
        }
    )


def _three_models(feeds):
    """The three trained recommenders by the metrics of one split: the values of the first follow from SQL, the others are shares."""
    lake = layers(feeds)
    found = flows.compare_recommenders(lake.interactions, lake.products, 10, ranker_iterations=5)
    known = F.col("model") == "item_similarity"
    return found.select("model", "metric", F.when(known, F.round("value", 6)).alias("value"), F.col("value").between(0, 1).alias("is_share"))


def _rounded_metrics(df):
    return _rounded(df, 6, *df.columns)


METRICS = "round(avg(precision_at_k), 6) AS {0}precision_at_k, round(avg(recall_at_k), 6) AS {0}recall_at_k, round(avg(ndcg_at_k), 6) AS {0}ndcg_at_k"

CHECKS = {
    # ordering
    "temporal_split": (
        _split_sides,
        query(
            "SELECT interaction_id, 'train' AS part FROM train_rows UNION ALL SELECT interaction_id, 'validation' FROM validation_rows"
        ),
    ),
    "demand_split": (
        lambda f: splits.demand_split(
            f.orders, tie_columns=["order_id", "product_id", "quantity", "total_amount"]
        )[1].select(F.col("quantity").cast("double").alias("q")),
        query("SELECT q FROM ordered_demand WHERE rn > greatest(1, floor(n * (1 - 0.2::DOUBLE)))"),
    ),
    "last_item_per_user": (
        lambda f: recommend.last_item_per_user(_split(f)[0]),
        query("SELECT * FROM last_items"),
    ),
    "topk_per_group": (
        lambda f: _customer_top(_split(f)[0]),
        query("SELECT * FROM customer_top"),
    ),
    "topk_global": (
        lambda f: ordering.topk_global(
            f.orders.select("order_id", "product_id", "total_amount"),
            25,
            F.col("total_amount").desc(),
            F.col("order_id"),
            F.col("product_id"),
        ),
        query(
            "SELECT order_id, product_id, total_amount FROM raw_orders ORDER BY total_amount DESC, order_id, product_id LIMIT 25"
        ),
    ),
    "order_by": (
        lambda f: ordering.with_position(
            f.orders.groupBy("product_id").agg(F.sum("quantity").alias("units")),
            F.col("units").desc(),
            F.col("product_id"),
        ),
        query(
            "SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, row_number() OVER (ORDER BY sum(quantity) DESC, product_id) - 1 AS position "
            "FROM raw_orders GROUP BY product_id"
        ),
    ),
    "factorize": (
        lambda f: ordering.factorize(f.table("part").select("p_partkey", "p_type", "p_brand"), "p_type"),
        "SELECT p_partkey, p_type, p_brand, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code FROM part",
    ),
    "id_codes": (
        lambda f: recommend.id_codes(f.product_interactions, "customer_id"),
        query(
            "SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS customer_id_code "
            "FROM (SELECT DISTINCT customer_id FROM raw_product_interactions)"
        ),
    ),
    "cumulative_pr": (
        lambda f: inventory.cumulative_pr(_scored_docs(f), "actual", "score"),
        query("SELECT * FROM pr_steps"),
    ),
    "stratified_split": (
        _strata,
        "SELECT doc_id, quality, toxic, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY md5('42|' || doc_id)) "
        "<= round(count(*) OVER (PARTITION BY toxic) * 0.2) THEN 'holdout' ELSE 'train' END AS part FROM labels",
    ),
    # inventory
    "demand_stats": (
        lambda f: _rounded(
            inventory.demand_stats(_site_demand(f), TODAY),
            6,
            "daily_demand_mean",
            "daily_demand_std",
            "demand_std",
            "demand_mean",
        ),
        query(
            "SELECT product_id, warehouse_id, round(daily_demand_mean, 6) AS daily_demand_mean, round(daily_demand_std, 6) AS daily_demand_std, "
            "round(demand_std, 6) AS demand_std, round(demand_mean, 6) AS demand_mean FROM demand_table"
        ),
    ),
    "demand_90d": (
        lambda f: inventory.demand_90d(layers(f).orders, TODAY),
        query("SELECT * FROM demand_90_table"),
    ),
    "reorder_point": (
        lambda f: inventory.demand_stats(_site_demand(f), TODAY).select(
            "product_id",
            "warehouse_id",
            F.round(
                inventory.reorder_point("demand_mean", "demand_std", F.col("product_id") % 5 * 1.0, 0.9), 6
            ).alias("reorder_point"),
        ),
        query(
            "SELECT product_id, warehouse_id, round(greatest(0, demand_mean * (product_id % 5) + 1.2815515655446004::DOUBLE * demand_std * "
            "sqrt(greatest(product_id % 5, 0.1::DOUBLE))), 6) AS reorder_point FROM demand_table"
        ),
    ),
    "replenishment_recommendations": (
        lambda f: _rounded(
            _replenishment(f).select(
                "inventory_id", "product_id", "warehouse_id", "reorder_point", "below_rop", "reorder_qty", "priority"
            ),
            6,
            "reorder_point",
            "reorder_qty",
        ),
        query(
            "SELECT inventory_id, product_id, warehouse_id, round(reorder_point, 6) AS reorder_point, below_rop, "
            "round(reorder_qty, 6) AS reorder_qty, CAST(CASE WHEN below_rop THEN 2 ELSE 0 END + CASE WHEN reorder_qty > 0 THEN 1 ELSE 0 END AS BIGINT) AS priority "
            "FROM replenishment_table"
        ),
    ),
    "replenishment_summary": (
        lambda f: _rounded(inventory.replenishment_summary(_replenishment(f)), 4, "total_reorder_qty"),
        query(
            "SELECT count(CASE WHEN below_rop THEN 1 END) AS below_rop_count, count(CASE WHEN reorder_qty > 0 THEN 1 END) AS reorder_lines, "
            "round(sum(reorder_qty), 4) AS total_reorder_qty FROM replenishment_table"
        ),
    ),
    "writeoff_features": (_risk_features, query("SELECT * FROM risk_table")),
    "expiry_label": (
        lambda f: inventory_features(layers(f).inventory).select(
            "pharmacy_id", "product_id", inventory.expiry_label().alias("will_expire_30d")
        ),
        query(
            "SELECT pharmacy_id, product_id, CAST(CASE WHEN days_until_expiry BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS BIGINT) AS will_expire_30d "
            "FROM silver_inventory"
        ),
    ),
    "classification_metrics": (
        lambda f: _rounded(
            inventory.classification_metrics(_scored_docs(f), "actual", "predicted", "score"),
            9,
            "accuracy",
            "f1",
            "precision",
            "recall",
            "positive_rate",
            "pr_auc",
        ),
        query(
            "SELECT round((n - fp - fn) / n, 9) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(tp / (tp + fp), 9) AS precision, "
            "round(tp / (tp + fn), 9) AS recall, round((tp + fn) / n, 9) AS positive_rate, "
            "(SELECT round(sum(recall_step * precision), 9) FROM pr_steps) AS pr_auc FROM confusion"
        ),
    ),
    "forecast_metrics": (
        lambda f: _rounded(
            inventory.forecast_metrics(
                f.table("lineitem").withColumn("guess", F.col("l_quantity") + F.col("l_linenumber")), "l_quantity", "guess"
            ),
            6,
            "mae",
            "rmse",
            "mape",
        ),
        "SELECT round(avg(l_linenumber), 6) AS mae, round(sqrt(avg(l_linenumber * l_linenumber)), 6) AS rmse, "
        "round(avg(l_linenumber / l_quantity) * 100, 6) AS mape FROM lineitem WHERE l_quantity > 0",
    ),
    "naive_mean_forecast": (_forecast, query(FORECAST)),
    "leak_guard": (
        lambda f: _risk_features(f).select(*inventory.leak_guard(_risk_features(f).columns)),
        query("SELECT * EXCLUDE (days_until_expiry) FROM risk_table"),
    ),
    "train_writeoff_classifier": (
        _risk_metrics,
        query(
            "SELECT round(p / (p + n), 9) AS positive_rate, true AS accuracy_is_own, true AS f1_is_own, true AS precision_is_own, "
            "true AS recall_is_own, true AS pr_auc_is_own FROM (SELECT round(0.2 * count(*) FILTER (WHERE days_until_expiry BETWEEN 0 "
            "AND 30))::DOUBLE AS p, round(0.2 * count(*) FILTER (WHERE NOT days_until_expiry BETWEEN 0 AND 30))::DOUBLE AS n FROM silver_inventory)"
        ),
    ),
    "predict_writeoff_risk": (
        _risk_rows,
        query(
            "SELECT inventory_id, CAST(days_until_expiry BETWEEN 0 AND 30 AS BIGINT) AS will_expire_30d, true AS is_probability, "
            "true AS equals_nodes FROM silver_inventory"
        ),
    ),
    # recommendation
    "training_base": (_base, query("SELECT * FROM base_table")),
    "interaction_weights": (
        lambda f: recommend.interaction_weights(layers(f).interactions),
        query("SELECT * FROM weight_table"),
    ),
    "user_item_counts": (
        lambda f: recommend.user_item_counts(recommend.interaction_weights(layers(f).interactions)),
        query(
            "SELECT count(DISTINCT customer_id) AS n_users, count(DISTINCT product_id) AS n_items, count(*) AS n_nonzero FROM weight_table"
        ),
    ),
    "distinct_pairs": (
        lambda f: recommend.distinct_pairs(f.orders),
        query(
            "SELECT DISTINCT CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id FROM raw_orders"
        ),
    ),
    "purchases_truth": (
        lambda f: recommend.purchases_truth(_split(f)[1]),
        query("SELECT * FROM truth_table"),
    ),
    "cap_users": (
        lambda f: recommend.cap_users(recommend.purchases_truth(_split(f)[1]), recommend.EVALUATION_USERS),
        query(
            "SELECT * FROM truth_table WHERE customer_id IN (SELECT DISTINCT customer_id FROM truth_table ORDER BY 1 LIMIT 500)"
        ),
    ),
    "product_features_matrix": (
        lambda f: recommend.product_features_matrix(layers(f).products),
        query("SELECT * FROM feature_matrix"),
    ),
    "standardize": (
        _standardized,
        query(f"SELECT product_id, {', '.join(f'round({c}, 6) AS {c}' for c in MATRIX)} FROM scaled_matrix"),
    ),
    "item_knn_cosine": (
        lambda f: recommend.item_similarity(layers(f).products),
        query("SELECT * FROM similar_products"),
    ),
    "embedding_knn_cosine": (_similar_embeddings, query("SELECT * FROM similar_embeddings")),
    # The same through many small cells, as on a large table.
    "embedding_knn_cosine_cells": (
        lambda f: _similar_embeddings(f, vectors_per_cell=60),
        query("SELECT * FROM similar_embeddings"),
    ),
    "anchor_recommendations": (_anchors, query("SELECT * FROM anchor_lists")),
    "not_purchased_counts": (
        lambda f: recommend.not_purchased_counts(
            _base(f).filter("label = 1"), layers(f).products
        ),
        query("SELECT * FROM free_counts"),
    ),
    "negative_samples": (_negatives, query("SELECT * FROM negative_table")),
    "with_negatives": (
        lambda f: recommend.with_negatives(_base(f), layers(f).products),
        query(
            "SELECT customer_id, product_id, label, last_interaction_timestamp, interaction_count FROM base_table "
            "UNION ALL SELECT customer_id, product_id, label, NULL, NULL FROM negative_table"
        ),
    ),
    "ranker_features": (_ranker_rows, query(RANKER_ROWS)),
    "train_ranker": (_ranker_scores, query("SELECT customer_id, product_id, true AS equals_nodes FROM base_table")),
    "group_ranker": (
        _group_ranked,
        query("SELECT customer_id, least(count(*), 5) AS n, true AS scores_recomputed FROM base_table GROUP BY customer_id"),
    ),
    "rank_candidates": (
        _ranked,
        query(f"SELECT customer_id, 10::BIGINT AS n, {FACTS} FROM base_table WHERE label = 1 GROUP BY customer_id"),
    ),
    "recommend_for_users": (lambda f: _factor_lists(f, _pairs_seen(f)), query(FACTOR_LISTS.format(UNSEEN))),
    "mf_topk_all_items": (_factor_lists, query(FACTOR_LISTS.format(""))),
    "recommendation_arrays": (
        lambda f: recommend.recommendation_arrays(_factor_lists(f)).select(
            "customer_id", F.array_join("recommended_item_codes", ",").alias("items"), F.array_join("recommended_scores", ",").alias("scores")
        ),
        query(
            "SELECT customer_id, string_agg(product_id, ',' ORDER BY rank) AS items, string_agg(score, ',' ORDER BY rank) AS scores FROM ("
            + FACTOR_LISTS.format("")
            + ") GROUP BY customer_id"
        ),
    ),
    "als_implicit": (_als_solved, query("SELECT customer_id, count(*) AS n_items, true AS solved FROM weight_table GROUP BY customer_id")),
    "als_objective": (_als_loss, "SELECT true AS falls, true AS below_zero_factors"),
    "als_recommend_for_users": (_als_recommendations, query(LIST_FACTS.format(" - count(DISTINCT product_id)"))),
    "als_all_items": (_als_all_items, query(LIST_FACTS.format(""))),
    "ranking_metrics_per_user": (
        lambda f: _rounded(_user_metrics(f), 9, "precision_at_k", "recall_at_k", "ndcg_at_k"),
        query(
            "SELECT customer_id, round(precision_at_k, 9) AS precision_at_k, round(recall_at_k, 9) AS recall_at_k, "
            "round(ndcg_at_k, 9) AS ndcg_at_k FROM user_metrics"
        ),
    ),
    "evaluate_recommendations": (
        lambda f: _rounded_metrics(_metrics(f)),
        query(f"SELECT {METRICS.format('')} FROM user_metrics"),
    ),
    "offline_metrics": (
        lambda f: _rounded_metrics(recommend.offline_metrics(_metrics(f))),
        query(f"SELECT {METRICS.format('val_')} FROM user_metrics"),
    ),
    "protocol_parameters": (
        lambda f: recommend.protocol_parameters(*_split(f)),
        query(
            "SELECT 'temporal_split_interactions' AS reco_eval_protocol, 0.2::DOUBLE AS reco_val_fraction, CAST(10 AS BIGINT) AS reco_eval_k, "
            "(SELECT count(*) FROM train_rows) AS reco_n_train_events, (SELECT count(*) FROM validation_rows) AS reco_n_val_events"
        ),
    ),
    "compare_recommenders": (
        _three_models,
        query(
            "\nUNION ALL ".join(
                f"SELECT '{model}' AS model, 'val_{metric}' AS metric, {value} AS value, true AS is_share {source}"
                for metric in ("precision_at_k", "recall_at_k", "ndcg_at_k")
                for model, value, source in (
                    ("item_similarity", f"coalesce(round(avg({metric}), 6), 0)", "FROM anchor_metrics"),
                    ("als", "CAST(NULL AS DOUBLE)", ""),
                    ("ranker", "CAST(NULL AS DOUBLE)", ""),
                )
            )
        ),
    ),
    "compare_models": (
        _compared,
        query(
            "\nUNION ALL ".join(
                f"SELECT '{model}' AS model, '{metric}' AS metric, round(avg({metric}), 6) AS value FROM {source}"
                for model, source in (("own_ten", "user_metrics"), ("own_three", "user_metrics_3"))
                for metric in ("precision_at_k", "recall_at_k", "ndcg_at_k")
            )
        ),
    ),
}
