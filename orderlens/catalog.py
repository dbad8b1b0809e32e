"""Every named query over the sample tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens import catalog_features, catalog_ml, catalog_reports, catalog_stats, catalog_streaming
from orderlens.constants import TABLES
from orderlens.plans import cleaning as cl
from orderlens.plans import column_rules as cr
from orderlens.plans import profile, quality
from orderlens.plans import sqlbank as q
from orderlens.session import delete_at_end, new_folder, tune
from orderlens.sources import files
from orderlens.sources.sample import clean_tables, raw_tables

AS_OF = "2001-08-01"  # the last order day of the sample tables


def _t(spark, d):
    return clean_tables(tune(spark), d)


def _r(spark, d):
    return raw_tables(tune(spark), d)


def over_clean(fn, **params):
    return lambda spark, d: fn(_t(spark, d), **params)


def sql_bank() -> dict:
    return {
        "a1_top_restaurants_revenue": over_clean(q.a1_top_restaurants_revenue, as_of=AS_OF),
        "a2_avg_delivery_by_city": over_clean(q.a2_avg_delivery_by_city),
        "a3_cuisine_having": over_clean(q.a3_cuisine_having, min_orders=100, min_rating=3.0),
        "a4_cancel_rate_by_cuisine": over_clean(q.a4_cancel_rate_by_cuisine),
        "b1_order_names": over_clean(q.b1_order_names),
        "b2_restaurant_feedback_left": over_clean(q.b2_restaurant_feedback_left),
        "b3_payment_right": over_clean(q.b3_payment_right),
        "b4_partner_pairs_self": over_clean(q.b4_partner_pairs_self),
        "b5_attention_union": over_clean(q.b5_attention_union),
        "c1_delivery_tier": over_clean(q.c1_delivery_tier),
        "c2_value_segment": over_clean(q.c2_value_segment, platinum=3_000_000, gold=2_000_000, silver=1_000_000),
        "d1_above_avg_cost": over_clean(q.d1_above_avg_cost),
        "d2_last_order_cancelled": over_clean(q.d2_last_order_cancelled),
        "d3_monthly_city_revenue_lag": over_clean(q.d3_monthly_city_revenue_lag),
        "d4_repeat_segment": over_clean(q.d4_repeat_segment),
        "e1_rank_in_city": over_clean(q.e1_rank_in_city),
        "e2_top3_per_city": over_clean(q.e2_top3_per_city),
        "e3_order_lag_lead": over_clean(q.e3_order_lag_lead),
        "e4_recency_rank": over_clean(q.e4_recency_rank, as_of=AS_OF),
        "f1_order_base_view": over_clean(q.f1_order_base_view),
        "f2_restaurant_scorecard_view": over_clean(q.f2_restaurant_scorecard_view),
        "g1_orders_by_weekday": over_clean(q.g1_orders_by_weekday),
        "g2_quarter_revenue": over_clean(q.g2_quarter_revenue),
        "g3_tenure_days": over_clean(q.g3_tenure_days, as_of=AS_OF),
        "h1_delivery_by_weather": over_clean(q.h1_delivery_by_weather),
        "h2_delivery_by_traffic": over_clean(q.h2_delivery_by_traffic),
        "h3_coupon_performance": over_clean(q.h3_coupon_performance),
        "h4_partner_top_decile": over_clean(q.h4_partner_top_decile),
        "i1_city_kpi_refresh": lambda s, d: q.i1_city_kpi_refresh(_t(s, d)).drop("LastRefreshed"),
        "audit_orphans": lambda s, d: q.audit_orphans(_t(s, d), _t(s, d)["orders_all"]),
    }


# decimals compared where a value is computed rather than copied
_ROUND = {
    "delivery_partners": {"AverageDeliveryTime": 6, "Rating": 6}, "weather": {"Temperature": 6, "Rainfall": 6},
    "traffic": {"AverageSpeed": 6}, "orders": {"FinalAmount": 2}, "order_items": {"TotalPrice": 2},
}


def _rounded(df, cols: dict):
    return df.withColumns({c: F.round(F.col(c), n) for c, n in cols.items()}) if cols else df


def table_jobs() -> dict:
    def job(table):
        return lambda s, d: _rounded(cl.Cleaner(_r(s, d)).table(table), _ROUND.get(table, {}))

    names = {t: f"clean_{'feedback' if t == 'customer_feedback' else t}" for t in cl.COLUMNS}
    return {names[t]: job(t) for t in cl.COLUMNS}


def over_raw(fn, **params):
    return lambda spark, d: fn(_r(spark, d), **params)


def column_rules() -> dict:
    raw = {
        "clean_text": cr.text, "parse_mixed_dates": cr.mixed_dates, "resolve_ambiguous_dates": cr.resolved_dates,
        "to_number": cr.numbers, "abs_sign_fix": cr.sign_fix, "dedupe_rows": cr.exact_duplicates,
        "dedupe_key_keep_first": cr.first_per_key, "impute_group_median": cr.group_median,
        "impute_global_median": cr.whole_median, "impute_constant": cr.constant, "impute_row_mean": cr.mean_of_others,
        "invalidate_range": cr.out_of_range, "validate_pattern": cr.patterns, "cap_iqr": cr.iqr_cap,
        "cap_percentile": cr.percentile_cap, "clip_constant": cr.constant_clip, "swap_reversed_dates": cr.swapped_dates,
        "fill_city_blocks": cr.city_blocks, "infer_nearest_class": cr.nearest_class, "recompute_amount": cr.amounts,
        "null_unknown_fk": cr.known_coupons, "upper_code": cr.coupon_case, "title_case": cr.city_case,
        "truncate_time": cr.short_times,
    }
    clean = {"canonical_city": cr.city_names, "drop_orphans": cr.without_orphans, "best_status_row": cr.best_payment}
    return {**{k: over_raw(f) for k, f in raw.items()}, **{k: over_clean(f) for k, f in clean.items()}}


def checks() -> dict:
    return {
        "cleaning_log": lambda s, d: cl.Cleaner(_r(s, d)).log(),
        "cleaning_log_summary": lambda s, d: cl.log_summary(cl.Cleaner(_r(s, d)).log()),
        "cleaning_log_by_table": lambda s, d: cl.log_by_table(cl.Cleaner(_r(s, d)).log()),
        "profile_tables": lambda s, d: profile.profile_tables(_r(s, d), TABLES),
        "profile_patterns": lambda s, d: profile.profile_patterns(_r(s, d)["orders"], "OrderDate"),
        "check_sign_flip": lambda s, d: profile.check_sign_flip(_r(s, d)["orders"]),
        "ambiguous_date_share": lambda s, d: profile.ambiguous_date_share(_r(s, d)["orders"], "OrderDate"),
        "check_pk_unique": over_clean(quality.pk_unique),
        "check_fk": over_clean(quality.fk_resolve),
        "check_ranges": over_clean(quality.ranges_hold),
        "validation_report": over_clean(quality.validation_report),
        "check_ddl_constraints": over_clean(quality.ddl_constraints),
    }


def _counts(frames: dict):
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _csv_out(raw, folder: str, names) -> None:
    for n in names:
        raw[n].drop("SourceRow").write.option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(f"{folder}/{n}.csv", header=True)


def _read_raw_text(s, d):
    folder = new_folder(s)
    _csv_out(_r(s, d), folder, ["customers"])
    return files.read_raw_text(s, "customers", folder).drop("SourceRow")


def _read_raw_all(s, d):
    folder = new_folder(s)
    _csv_out(_r(s, d), folder, TABLES)
    return _counts(files.read_raw_all(s, folder))


def _store_clean(s, d) -> str:
    folder, t = new_folder(s), _t(s, d)
    for n in TABLES:
        cl.whole_numbers(n, t[n].select(*cl.COLUMNS[n])).write.parquet(f"{folder}/{n}")
    return folder


def _read_clean(s, d):
    orders = files.read_clean(s, _store_clean(s, d))["orders"]
    return orders.select("OrderID", "OrderDate", "DeliveryTimeMinutes", "FinalAmount", "CouponCode")


def _write_clean(s, d):
    folder = new_folder(s)
    t = _t(s, d)
    files.write_clean(cl.Cleaner(_r(s, d)), folder, report=quality.validation_report(t))
    log, report = (s.read.parquet(f"{folder}/{n}") for n in ("cleaning_log", "validation_report"))
    return _counts({**files.read_clean(s, folder), "cleaning_log": log, "validation_report": report})


def _bulk_load(s, d):
    folder, t = new_folder(s), _t(s, d)
    name = "load_" + folder.rsplit("/", 1)[1]
    delete_at_end(s, folder)
    files.bulk_load(t, name, folder)
    return _counts(files.open_database(s, name, folder))


def file_jobs() -> dict:
    return {
        "read_raw_text": _read_raw_text, "read_raw_all": _read_raw_all, "read_clean": _read_clean,
        "write_clean": _write_clean, "bulk_load_relational": _bulk_load,
    }


def all_queries() -> dict:
    named = {**catalog_features.QUERIES}
    return {
        **sql_bank(), **table_jobs(), **column_rules(), **checks(), **file_jobs(),
        **{k: over_clean(f) for k, f in named.items()}, **catalog_reports.queries(),
        **catalog_stats.queries(), **catalog_ml.queries(), **catalog_streaming.queries(),
    }
