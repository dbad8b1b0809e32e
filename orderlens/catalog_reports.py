"""Star schema, measure, KPI, chart and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.catalog_features import FROM_BASE, rounded
from orderlens.plans import kpis as k
from orderlens.plans import measures as m
from orderlens.plans import star as st
from orderlens.session import new_folder
from orderlens.sources import files
from orderlens.store import Store

SCORE_ROUND = {c: 6 for c in ("CancelRate", "LateRate", "AvgDeliveryTime", "CompositeScore")} | {"Revenue": 2}


def r6(df):
    """Doubles to six places, sums of money to two."""
    return df.withColumns({f: F.round(F.col(f"`{f}`"), 2 if f in k.MONEY else 6) for f, t in df.dtypes if t == "double"})


def sample_predictions(base):
    """Columns of a prediction table from key arithmetic, to check metric queries."""
    d = base.filter("IsDelivered and DeliveryTimeMinutes is not null and OrderID % 5 = 0")
    p = (F.col("OrderID") % 40 + 20).cast("double")
    return d.select("OrderID", "RCity", "OrderDate", F.col("DeliveryTimeMinutes").cast("double").alias("Actual"), p.alias("Predicted"),
                    (F.col("DeliveryTimeMinutes") - p).alias("Residual"))


def sample_scores(churn):
    p = (F.col("CustomerID") * 37 % 100) / 100.0
    return churn.select("CustomerID", "Recency", "Frequency", "Monetary", "Churn", p.alias("ChurnProbability"),
                        F.when(F.col("CustomerID") % 5 == 0, "test").otherwise("train").alias("Split"))


def with_segments(scores):
    from orderlens.ml.scores import risk_segments

    return risk_segments(scores)


def _measures_kpi(s):
    names = ["Total Orders", "Completed Orders", "Total Revenue", "Avg Order Value", "Avg Delivery Time", "P90 Delivery Time", "Avg Rating",
             "Late %", "Cancellation %", "Failure %"]
    return r6(m.evaluate(s.star, names, ["dim_city.City"]))


def _evaluate(s):
    out = m.evaluate(
        s.star, ["Total Orders", "Total Revenue", "Late %"], ["dim_restaurant.Cuisine", "dim_customer.Membership"],
        {"dim_city.City": ["ASIA", "EUROPE"], "dim_date.Date": ("1996-01-01", "1999-12-31")})
    return r6(out)


def _months(s):
    out = m.evaluate_months(s.star, ["dim_city.City"], {"dim_date.Date": ("1996-01-01", "1997-12-31"), "dim_customer.Membership": ["BUILDING", "MACHINERY"], "dim_menu.Category": ["none"]})
    return r6(out)


def _items_by_city(s):
    """Two relationships in a row: predictions, their orders, the orders' restaurants."""
    star = {**s.star, "ml_delivery_predictions": sample_predictions(s.base)}
    return r6(m.evaluate(star, ["Delivery MAE", "Avg Actual"], ["dim_restaurant.Cuisine"], {"dim_customer.Membership": ["BUILDING"]}))


def _customer_measures(s):
    names = ["Customers", "Ordering Customers", "Repeat Customers", "Retention Rate", "One-time Customers %", "Avg CLV"]
    return r6(m.evaluate(s.star, names, ["dim_customer.Membership"]))


def _restaurant_measures(s):
    a = m.evaluate(s.star, ["Avg Composite Score", "Avg Restaurant Rating"], ["dim_restaurant.Cuisine"])
    b = m.evaluate(s.star, ["Restaurant Revenue", "Restaurant Cancel %"], ["dim_restaurant.Cuisine"])
    return r6(a.join(b, "Cuisine", "left"))


def _report_scores(s):
    a, b = m.evaluate(s.star, ["Top 10 Score"]), m.evaluate(s.star, ["Bottom 10 Score"])
    return r6(a.withColumn("Bottom 10 Score", b.scalar()))


def _delivery_measures(s):
    by = ["dim_partner.DeliveryPartnerID", "dim_partner.VehicleType"]
    return r6(m.evaluate(s.star, ["Partner Deliveries", "Partner Avg Time", "Avg Time (10+ deliveries)"], by))


def _impact(s):
    return r6(m.evaluate(s.star, ["Traffic Impact"], ["fact_orders.TrafficScore", "fact_orders.RainImpact"]))


def _sales_measures(s):
    return r6(m.evaluate(s.star, ["Total Discount", "Coupon Usage %", "Discount % of Revenue"], ["dim_date.YearMonth"]))


def _ml_star(s):
    scores = with_segments(sample_scores(s.churn))
    return {**s.star, "ml_delivery_predictions": sample_predictions(s.base), "ml_churn_scores": scores}


def ml_measures(star):
    a = m.evaluate(star, ["Delivery MAE", "Delivery RMSE", "Delivery R2", "Avg Predicted", "Avg Actual"])
    b = m.evaluate(star, ["Test Customers", "High-risk Customers", "Actual Churn % (test)"])
    out = a
    for c in b.columns:
        out = out.withColumn(c, b.select(F.col(f"`{c}`")).scalar())
    return r6(out)


def _export_star(s):
    folder = new_folder(s.spark)
    files.export_tables(s.star, folder, by_month=("fact_orders",))
    parts = [s.spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in s.star]
    return k.union(parts)


def _kpi_json(s):
    folder = new_folder(s.spark)
    doc = k.kpi_document(s.base)
    files.write_json(doc, folder)
    back = s.spark.read.schema(doc.schema).json(folder)
    return back.select("orders_total", "completed_orders", F.round("revenue", 2).alias("revenue"), F.round("late_pct_of_completed", 6).alias("late_pct_of_completed"))


def _score_rounded(df):
    return rounded(df, SCORE_ROUND)


QUERIES = {
    "dim_date": lambda s: st.dim_date(s.base),
    "dim_city": lambda s: s.star["dim_city"],
    "dim_partner": lambda s: s.star["dim_partner"],
    "dim_promotion": lambda s: s.star["dim_promotion"],
    "dim_menu": lambda s: s.star["dim_menu"],
    "fact_order_items": lambda s: r6(s.star["fact_order_items"]),
    "dim_customer": lambda s: rounded(s.star["dim_customer"], {"CLV": 2}),
    "customer_segment": lambda s: s.star["dim_customer"].groupBy("Segment").agg(F.count(F.lit(1)).alias("n")),
    "customer_type": lambda s: s.star["dim_customer"].groupBy("CustomerType").agg(F.count(F.lit(1)).alias("n")),
    "clv_band": lambda s: s.t["orders"].select("OrderID", st.clv_band(F.col("FinalAmount") / 200).alias("band"), st.clv_band_order(F.col("FinalAmount") / 200).alias("band_order")),
    "dim_restaurant": lambda s: _score_rounded(s.star["dim_restaurant"]),
    "rpt_restaurant_top10": lambda s: _score_rounded(s.star["rpt_restaurant_top10"]),
    "rpt_restaurant_bottom10": lambda s: _score_rounded(s.star["rpt_restaurant_bottom10"]),
    "fact_orders": lambda s: rounded(s.star["fact_orders"]),
    "restaurant_scorecard": lambda s: _score_rounded(st.scorecard(s.base)),
    "restaurants_top10_per_city": lambda s: _score_rounded(st.top_per_city(s.score)),
    "restaurants_bottom10_per_city": lambda s: _score_rounded(st.bottom_per_city(s.score)),
    "export_star_schema": _export_star,
    "evaluate_measures": _evaluate,
    "evaluate_months": _months,
    "active_customers_by_date": lambda s: m.active_customers(s.star, ["dim_city.City"], {"dim_date.Date": ("1996-01-01", "1997-12-31")}),
    "evaluate_chain": _items_by_city,
    "measures_kpi": _measures_kpi,
    "measures_time": lambda s: r6(m.measures_time(s.star)),
    "measures_revenue_30d": lambda s: r6(m.revenue_30d_avg(s.star)),
    "measures_new_customers": lambda s: m.new_customers_by_month(s.star),
    "measures_customer": _customer_measures,
    "measures_restaurant": _restaurant_measures,
    "measures_report_scores": _report_scores,
    "measures_delivery": _delivery_measures,
    "measures_impact": _impact,
    "measures_sales": _sales_measures,
    "measures_ml_by_key": lambda s: ml_measures(_ml_star(s)),
    "kpi_headline": lambda s: r6(k.kpi_headline(s.base)),
    "kpi_argmax": lambda s: k.kpi_argmax(s.base),
    "kpi_breakdowns": lambda s: k.kpi_breakdowns(s.base),
    "kpi_join_rates": lambda s: r6(k.kpi_join_rates(s.base)),
    "kpi_top5": lambda s: k.kpi_top5(s.base),
    "kpi_correlation": lambda s: r6(k.kpi_correlation(s.base)),
    "two_sample_z": lambda s: r6(k.two_sample_z(s.base)),
    "write_kpi_json": _kpi_json,
    "chart_rank_bars": lambda s: k.chart_rank_bars(s.base, s.t),
    "chart_monthly": lambda s: k.chart_monthly(s.base),
    "chart_cumulative_revenue": lambda s: k.chart_cumulative_revenue(s.base),
    "chart_shares": lambda s: k.chart_shares(s.base),
    "chart_counts": lambda s: k.chart_counts(s.base),
    "chart_pivots": lambda s: k.chart_pivots(s.base),
    "chart_orders_per_day_by_hour": lambda s: k.chart_orders_per_day_by_hour(s.base),
    "chart_rates": lambda s: k.chart_rates(s.base),
    "chart_mean_sem": lambda s: k.chart_mean_sem(s.base),
    "chart_avg_basket": lambda s: k.chart_avg_basket(s.base),
    "chart_histogram": lambda s: k.chart_histogram(s.base, s.star["dim_customer"]),
    "chart_box_stats": lambda s: k.chart_box_stats(s.base),
    "chart_letter_values": lambda s: k.letter_values(s.base),
    "chart_density": lambda s: k.chart_density(s.base),
    "chart_scatter_fit": lambda s: k.chart_scatter_fit(s.base),
    "chart_scatter_sample": lambda s: k.chart_scatter_sample(s.base),
    "chart_corr_matrix": lambda s: k.chart_corr_matrix(s.base),
    "chart_pair_sample": lambda s: k.chart_pair_sample(s.base),
    "chart_restaurant_sample": lambda s: k.restaurant_sample(s.t),
    "payment_reconciliation": lambda s: k.payment_reconciliation(s.base),
    "payment_reconciliation_by_status": lambda s: k.failed_by_payment(s.base),
    "naive_forecast": lambda s: k.naive_forecast(s.base),
    "late_vs_ontime_summary": lambda s: k.late_vs_ontime(s.base),
    "rating_vs_cancel_corr": lambda s: k.rating_vs_cancel(s.base),
    "coupon_aov": lambda s: k.coupon_aov(s.base),
    "dash_executive": lambda s: k.dash_executive(s.star),
    "dash_customer": lambda s: k.dash_customer(s.star),
    "dash_restaurant": lambda s: k.dash_restaurant(s.star, s.score),
    "dash_delivery": lambda s: k.dash_delivery(s.star),
    "dash_partner_leaderboard": lambda s: k.partner_leaderboard(s.star),
    "dash_sales": lambda s: k.dash_sales(s.star),
    "dash_ml_by_key": lambda s: k.dash_ml(sample_predictions(s.base), with_segments(sample_scores(s.churn))),
}


def over_store(fn):
    return lambda spark, d: fn(Store(spark, d))


def queries() -> dict:
    return {name: over_store(fn) for name, fn in {**FROM_BASE, **QUERIES}.items()}


