"""The table contracts: name, layer, primary key, builder."""

from __future__ import annotations

from featuremill.plans import accounts, geo, item_gold, item_silver, ranking, search_gold, search_silver
from featuremill.sources.schema import FeatureTable

# name -> (layer, primary key, builder)
_CONTRACTS = {
    "account_category_events": ("silver", ("date", "account_id", "category_id"), search_silver.account_category_events),
    "item_orders": ("silver", ("date", "sku_group_id"), item_silver.item_orders),
    "ad_revenue_daily": ("silver", ("date", "sku_group_id"), item_silver.ad_revenue_daily),
    "item_prices": ("silver", ("date", "sku_group_id"), item_silver.item_prices),
    "sku_stock_daily": ("silver", ("date", "sku_id"), item_silver.sku_stock_daily),
    "search_funnel_daily": ("silver", ("date", "install_id", "sku_group_id", "space", "uniqs"), search_silver.search_funnel_daily),
    "product_top_queries": ("silver", ("date", "product_id"), search_silver.product_top_queries),
    "query_item_daily_conversions": ("silver", ("date", "query", "platform", "sku_group_id"), search_silver.query_item_daily_conversions),
    "query_item_orders": ("silver", ("date", "query", "sku_group_id"), item_silver.query_item_orders),
    "score_change_log": ("silver", ("date", "query", "sku_group_id", "collected_at"), search_silver.score_change_log),
    "query_candidates": ("silver", ("date", "query"), search_silver.query_candidates),
    "account_lifetime_facts": ("silver", ("date", "account_id"), item_silver.account_lifetime_facts),
    "daily_discounts": ("silver", ("date", "sku_id", "promotion_id"), item_silver.daily_discounts),
    "completion_by_category": ("silver", ("date", "category_level", "category_id"), item_silver.completion_by_category),
    "completion_by_city": ("silver", ("date", "order_city_id"), item_silver.completion_by),
    "completion_by_region": ("silver", ("date", "order_region_id"), item_silver.completion_by),
    "delivery_unit_cost": ("silver", ("date", "city_id", "dimensional_group"), item_silver.delivery_unit_cost),
    "hex_user_activity": ("silver", ("date", "h3_index"), geo.hex_user_activity),
    "hex_user_location": ("silver", ("date", "h3_index"), geo.hex_user_location),
    "hex_demography": ("silver", ("date", "h3_index"), geo.hex_demography),
    "hex_poi_counts": ("silver", ("date", "h3_index"), geo.hex_poi_counts),
    "hex_neighbour_orders": ("silver", ("date", "h3_index"), geo.hex_neighbour_orders),
    "relevance_features": ("silver", ("date", "query", "sku_group_id"), search_silver.relevance_features),
    "feedback_by_product": ("gold", ("date", "product_id"), item_gold.feedback_stats),
    "feedback_by_item": ("gold", ("date", "sku_group_id"), item_gold.feedback_stats),
    "discounted_prices": ("gold", ("calculated_at", "sku_id", "promotion_id"), item_gold.discounted_prices),
    "discounted_prices_by_group": ("gold", ("calculated_at", "sku_group_id", "promotion_id"), item_gold.discounted_prices_by_group),
    "price_index_status": ("gold", ("date", "sku_group_id"), item_gold.price_index_status),
    "price_features": ("gold", ("date", "sku_group_id", "category_id"), item_gold.price_features),
    "stock_features": ("gold", ("date", "sku_group_id"), item_gold.stock_features),
    "ad_revenue_features": ("gold", ("date", "sku_group_id"), item_gold.ad_revenue_features),
    "search_conversion_v1": ("gold", ("date", "sku_group_id"), search_gold.search_conversion_v1),
    "search_conversion_v2": ("gold", ("date", "sku_group_id"), search_gold.search_conversion_v2),
    "query_features": ("gold", ("date", "query"), search_gold.query_features),
    "query_features_canonical": ("gold", ("date", "query"), search_gold.query_features_canonical),
    "pair_features_v1": ("gold", ("date", "query", "sku_group_id"), search_gold.pair_features_v1),
    "pair_features_v2": ("gold", ("date", "query", "sku_group_id"), search_gold.pair_features_v2),
    "pair_features_canonical": ("gold", ("date", "query", "sku_group_id"), search_gold.pair_features_canonical),
    "pair_conversions_legacy": ("gold", ("date", "query", "sku_group_id"), search_gold.pair_conversions_legacy),
    "pair_latest_legacy": ("gold", ("date", "query", "sku_group_id"), search_gold.pair_latest_legacy),
    "query_text_pair_features": ("gold", ("date", "sku_group_id", "query_text"), search_gold.query_text_pair_features),
    "query_dictionary": ("gold", ("query_text", "version"), search_gold.query_dictionary),
    "item_buyout_signal": ("gold", ("date", "key_type", "key_id"), item_gold.item_buyout_signal),
    "sku_buyout_online": ("gold", ("date", "sku_id"), item_gold.sku_buyout_online),
    "city_cost_online": ("gold", ("date", "city_id", "dimensional_group"), item_gold.city_cost_online),
    "account_history_online": ("gold", ("date", "account_id"), accounts.account_history_online),
    "account_buyout_history": ("gold", ("date", "account_id"), accounts.account_buyout_history),
    "hex_forecast_mart": ("gold", ("date", "h3_index"), geo.hex_forecast_mart),
    "search_ranking_dataset": (
        "dataset", ("event_date", "install_id", "session_id", "query", "position"), ranking.search_ranking_dataset,
    ),
}

# The change log keeps every change of a day and the dictionary every key; tables of timestamps or events replace what they bring.
_APPENDED = {"score_change_log", "query_dictionary"}
_SNAPSHOTS = {"discounted_prices", "discounted_prices_by_group", "search_ranking_dataset"}


def _mode(name: str) -> str:
    return "append" if name in _APPENDED else "replace_snapshot" if name in _SNAPSHOTS else "replace_day"


TABLES = {name: FeatureTable(name, *contract, _mode(name)) for name, contract in _CONTRACTS.items()}
