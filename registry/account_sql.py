"""Oracle SQL of the account history.

Every account is one row with the list of its orders, each order a structure made from the list of its items; all
measures are list expressions over these. (The builder aggregates and joins instead.)
"""

from __future__ import annotations

from registry.silver_queries import CAUSES

DS = "DATE '2024-01-31'"
NEVER = "TIMESTAMP '1970-01-01 00:00:00'"

_STATUS, _CAUSE = "real_order_item_status", "nullif(return_cause, '')"
_BACK_UNSEEN = "(issued_at IS NULL AND returned_at IS NOT NULL AND delivered_at IS NOT NULL)"
_BACK_SEEN = "(issued_at IS NOT NULL AND returned_at IS NOT NULL)"
_WAITED = "date_sub('day', delivered_at, returned_at)"
_HELD = "date_sub('minute', issued_at, returned_at)"
_OWN_WILL = f"coalesce({_CAUSE}, 'NONE') NOT IN ('CANCELED', 'MISSING')"

#: What became of an item, over columns of the history view.
OUTCOMES = {
    "delivered": "delivered_at IS NOT NULL OR (delivery_type = 'COURIER' AND issued_at IS NOT NULL)",
    "active": f"{_STATUS} = 'ACTIVE'",
    "completed": f"{_STATUS} = 'COMPLETED'",
    "cancelled_before": f"{_STATUS} = 'RETURNED BEFORE DELIVERY'",
    "fair_return": f"{_CAUSE} IN {CAUSES} AND returned_at IS NOT NULL",
    "no_show": f"{_BACK_UNSEEN} AND {_WAITED} >= 6 AND {_CAUSE} = 'CANCELED'",
    "late_cancel": f"{_BACK_UNSEEN} AND {_WAITED} < 6 AND {_CAUSE} = 'CANCELED'",
    "handover_return": f"({_BACK_SEEN} AND {_HELD} BETWEEN 0 AND 60 AND {_OWN_WILL}) OR ({_BACK_UNSEEN} AND coalesce({_CAUSE}, 'NONE') <> 'CANCELED')",
    "later_return": f"{_BACK_SEEN} AND {_HELD} > 60 AND {_OWN_WILL}",
    "refused": f"{_STATUS} = 'RETURNED NO SHOW' OR ({_STATUS} = 'RETURNED' AND {_CAUSE} = 'CANCELED')",
}


def _struct(fields: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{name}': {value}" for name, value in fields.items()) + "}"


def _money(outcome: str) -> str:
    return f"CAST(list_sum([CASE WHEN i.{outcome} THEN i.gmv ELSE 0 END for i in items]) AS DOUBLE)"


_ITEM_FIELDS = {
    "id": "order_item_id", "at": "generated_at", "back_at": "returned_at", "cause": _CAUSE, "payment": "payment_type", "city": "order_city_id",
    "region": "order_region_id", "point": "delivery_point_id", "gmv": "gmv_generated", "paid": "gmv_completed",
    **{name: f"coalesce({rule}, false)" for name, rule in OUTCOMES.items()},
}
_REFUSAL_KIND = "CASE WHEN i.no_show THEN 'no_show' WHEN i.late_cancel THEN 'cancel_after_delivery' ELSE 'courier_or_other' END"
_LAST_BACK = f"""list_sort([{{'at': coalesce(i.back_at, {NEVER}), 'id': i.id, 'kind': CASE WHEN i.refused THEN {_REFUSAL_KIND} END,
      'cause': CASE WHEN i.refused THEN i.cause END}} for i in items])[-1]"""
_ORDER_FIELDS = {
    "at": "list_min([i.at for i in items])", "id": "order_id", "payment": "items[1].payment", "city": "items[1].city", "region": "items[1].region",
    "point": "items[1].point", "size": "len(items)",
    **{name: f"len([i for i in items if i.{name}])" for name in OUTCOMES},
    "gmv": "CAST(list_sum([i.gmv for i in items]) AS DOUBLE)", "paid": "CAST(list_sum([i.paid for i in items]) AS DOUBLE)",
    "gmv_delivered": _money("delivered"), "gmv_fair": _money("fair_return"), "gmv_no_show": _money("no_show"),
    "refused_at": "list_min([i.back_at for i in items if i.refused])", "last_back": _LAST_BACK,
}

# Two steps of structures: what counts of its items tell of an order, then what follows from these.
_DERIVED = {
    "day": "CAST(o.at + INTERVAL 5 HOUR AS DATE)",
    "ago": f"date_diff('day', CAST(o.at + INTERVAL 5 HOUR AS DATE), {DS})",
    "resolved": "o.active = 0 AND o.delivered > 0",
    "bad": "CASE WHEN o.refused > 0 THEN 1 ELSE 0 END",
    "postpaid": "CASE WHEN coalesce(o.payment IN ('PostPaid', 'Postpaid'), false) THEN 1 ELSE 0 END",
    "instalment": "CASE WHEN coalesce(o.payment IN ('Nasiya', 'Paymart', 'PaymartMfo', 'PaymartMFO'), false) THEN 1 ELSE 0 END",
    "due": "o.gmv_delivered - o.gmv_fair",
    "rate": "CASE WHEN o.gmv_delivered - o.gmv_fair > 0 THEN o.paid / (o.gmv_delivered - o.gmv_fair) END",
}

#: One row per account: all orders from first to last, the resolved ones from last to first.
ACCOUNTS = f"""
order_items AS (
  SELECT account_id, order_id, list({_struct(_ITEM_FIELDS)} ORDER BY order_item_id) AS items
  FROM v_history WHERE account_id > 0 GROUP BY account_id, order_id),
orders_made AS (SELECT account_id, {_struct(_ORDER_FIELDS)} AS o FROM order_items),
orders_judged AS (SELECT account_id, struct_pack(own := o, {', '.join(f'{n} := {e}' for n, e in _DERIVED.items())}) AS x FROM orders_made),
account_orders AS (
  SELECT account_id, list(x ORDER BY x.own.at, x.own.id) AS all_orders FROM orders_judged GROUP BY account_id),
accounts AS (
  SELECT account_id, all_orders, list_reverse([x for x in all_orders if x.resolved]) AS latest FROM account_orders),
streaks AS (
  SELECT account_id, latest[1].bad AS outcome,
    coalesce(list_position([x.bad for x in latest], 1 - latest[1].bad) - 1, len(latest)) AS n
  FROM accounts WHERE len(latest) > 0)"""


def _sum(value: str, where: str = "true") -> str:
    return f"list_sum([{value} for x in all_orders if {where}])"


def _count(where: str) -> str:
    return f"len([x for x in all_orders if {where}])"


def _rate(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} END"


def _buyout(where: str) -> str:
    """Money kept of money due, over the orders that meet a condition."""
    return _rate(_sum("x.own.paid", where), f"(coalesce({_sum('x.own.gmv_delivered', where)}, 0) - coalesce({_sum('x.own.gmv_fair', where)}, 0))")


def _mean_of_last(k: int) -> str:
    return f"list_avg([x.rate for x in latest[1:{k}]])"


def _long(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


_ITEMS = {name: _sum(f"x.own.{name}") for name in OUTCOMES}
_ALL_BAD = "(" + " + ".join(_ITEMS[n] for n in ("no_show", "late_cancel", "handover_return", "later_return")) + ")"
_N, _DELIVERED, _NEVER_LEFT = "len(all_orders)", _count("x.own.delivered > 0"), _count("x.own.cancelled_before = x.own.size")
_EVENTS, _FIRST, _LAST = _sum("x.bad"), "all_orders[1]", "all_orders[-1]"
_FIRST_3 = "list_avg([x.rate for x in list_reverse(latest)[1:3]])"
_LAST_REFUSAL = f"list_sort([{{'at': coalesce(x.own.refused_at, {NEVER}), 'id': x.own.id, 'kind': x.own.last_back.kind, 'cause': x.own.last_back.cause}} for x in all_orders])[-1]"
_GMVS, _DAYS = "[x.own.gmv for x in all_orders if x.own.gmv IS NOT NULL]", "[x.day for x in all_orders]"


def _days_since(instant: str) -> str:
    return f"CAST(date_diff('day', CAST({instant} + INTERVAL 5 HOUR AS DATE), {DS}) AS INTEGER)"


_MEASURES = {
    "n_orders_win": _long(_N), "n_delivered_orders_win": _long(_DELIVERED), "n_resolved_orders_win": _long("len(latest)"),
    "n_orders_30d": _long(_count("x.ago <= 30")), "n_orders_90d": _long(_count("x.ago <= 90")), "n_orders_in_processing": _long(_count("x.own.active > 0")),
    "buyout_rate_money_win": _buyout("true"), "buyout_rate_money_90d": _buyout("x.ago <= 90"), "buyout_rate_money_30d": _buyout("x.ago <= 30"),
    "buyout_rate_items_win": _rate(_ITEMS["completed"], _ITEMS["delivered"]), "buyout_rate_orders_win": f"1.0 - {_rate(_EVENTS, _DELIVERED)}",
    **{f"buyout_rate_last_{k}": _mean_of_last(k) for k in (3, 5, 10)}, "buyout_rate_first_3": _FIRST_3,
    "buyout_trend": f"CASE WHEN len(latest) >= 4 THEN {_mean_of_last(3)} - {_FIRST_3} END",
    "prev_order_is_nonbuyout": "coalesce(latest[1].bad, 0)", "prev2_order_is_nonbuyout": "coalesce(latest[2].bad, 0)", "prev3_order_is_nonbuyout": "coalesce(latest[3].bad, 0)",
    **{f"n_bad_last_{k}": _long(f"list_sum([x.bad for x in latest[1:{k}]])") for k in (3, 5, 10)},
    "buyout_streak": _long("CASE WHEN streaks.outcome = 0 THEN streaks.n ELSE 0 END"), "nonbuyout_streak": _long("CASE WHEN streaks.outcome = 1 THEN streaks.n ELSE 0 END"),
    "n_items_no_show": _long(_ITEMS["no_show"]), "n_items_cancel_after_delivery": _long(_ITEMS["late_cancel"]), "n_items_return_at_handover": _long(_ITEMS["handover_return"]),
    "n_items_return_post_handover": _long(_ITEMS["later_return"]), "n_items_fair_return": _long(_ITEMS["fair_return"]),
    "n_items_cancel_before_delivery": _long(_ITEMS["cancelled_before"]), "n_orders_cancelled_before_delivery": _long(_NEVER_LEFT),
    "no_show_share_of_delivered": _rate(_ITEMS["no_show"], _ITEMS["delivered"]), "no_show_share_of_nonbuyout": _rate(_ITEMS["no_show"], _ALL_BAD),
    "cancel_before_delivery_share": _rate(_NEVER_LEFT, _N), "no_show_gmv_share": _rate(_sum("x.own.gmv_no_show"), _sum("x.own.gmv_delivered")),
    "n_nonbuyout_events": _long(_EVENTS), "is_after_first_non_buyout": f"CASE WHEN {_EVENTS} > 0 THEN 1 ELSE 0 END",
    "days_since_first_nonbuyout": _days_since("list_min([x.own.refused_at for x in all_orders])"), "days_since_last_nonbuyout": _days_since("list_max([x.own.refused_at for x in all_orders])"),
    "last_nonbuyout_type": f"{_LAST_REFUSAL}.kind", "last_nonbuyout_cause": f"{_LAST_REFUSAL}.cause",
    "postpaid_share_win": _rate(_sum("x.postpaid"), _N), "installment_share_win": _rate(_sum("x.instalment"), _N),
    "buyout_rate_postpaid": _buyout("x.postpaid = 1"), "buyout_rate_prepaid": _buyout("x.postpaid = 0 AND x.instalment = 0"),
    "first_order_in_win_is_postpaid": f"{_FIRST}.postpaid", "last_order_payment_type": f"{_LAST}.own.payment", "last_order_is_postpaid": f"{_LAST}.postpaid",
    "avg_ticket_win": f"CAST(list_sum([CAST(g AS DECIMAL(38,8)) for g in {_GMVS}]) AS DOUBLE) / len({_GMVS})",
    "median_ticket_win": f"list_reverse_sort({_GMVS})[CAST(ceil(len({_GMVS}) / 2.0) AS INTEGER)]",
    "std_ticket_win": f"list_stddev_pop({_GMVS})", "max_ticket_win": f"list_max({_GMVS})", "avg_items_per_order_win": "list_avg([CAST(x.own.size AS DOUBLE) for x in all_orders])",
    "n_distinct_dp_win": _long("list_unique([x.own.point for x in all_orders])"), "n_distinct_city_win": _long("list_unique([x.own.city for x in all_orders])"),
    "last_order_city_id": f"{_LAST}.own.city", "last_order_region_id": f"{_LAST}.own.region", "first_order_date_win": f"list_min({_DAYS})", "last_order_date_win": f"list_max({_DAYS})",
    "days_since_last_order_win": f"CAST(date_diff('day', list_max({_DAYS}), {DS}) AS INTEGER)", "tenure_days_win": f"CAST(date_diff('day', list_min({_DAYS}), {DS}) AS INTEGER)",
    "history_left_censored": f"CASE WHEN list_min({_DAYS}) <= DATE '2023-08-08' THEN 1 ELSE 0 END",
}

_SNAPSHOT = "TIMESTAMP '2024-01-31 19:00:00'"
_CREATED = ", ".join(f"count(*) FILTER (WHERE date_sub('second', made_at, {_SNAPSHOT}) <= {d} * 86400) AS orders_created_prev_{d}d" for d in (1, 7, 30, 90, 365))

HISTORY_SQL = f"""
WITH {ACCOUNTS.strip()},
measures AS (SELECT account_id, {', '.join(f'{e} AS {n}' for n, e in _MEASURES.items())} FROM accounts LEFT JOIN streaks USING (account_id)),
created AS (
  SELECT account_id, {_CREATED}
  FROM (SELECT account_id, min(generated_at) AS made_at FROM v_order_items
    WHERE account_id > 0 AND order_item_status NOT IN ('CREATED', 'NOT_CREATED')
      AND purchased_at >= TIMESTAMP '2023-01-23 19:00:00' AND purchased_at < TIMESTAMP '2024-02-02 19:00:00'
    GROUP BY account_id, order_id) q
  WHERE made_at < {_SNAPSHOT} GROUP BY account_id)
SELECT {DS} AS date, measures.*, created.* EXCLUDE (account_id), o_life.* EXCLUDE (account_id, date),
  CAST(date_diff('day', first_order_date_ever, {DS}) AS INTEGER) AS tenure_days_true, CAST(date_diff('day', registration_date, {DS}) AS INTEGER) AS days_since_registration,
  CASE WHEN first_order_date_ever IS NULL THEN NULL WHEN first_order_date_ever < {DS} - 182 THEN 1 ELSE 0 END AS history_left_censored_true
FROM measures LEFT JOIN created USING (account_id) LEFT JOIN o_life USING (account_id)"""

LAST_MEANS_SQL = f"WITH {ACCOUNTS.strip()} SELECT account_id, round({_mean_of_last(3)}, 6) AS last_3, round({_mean_of_last(5)}, 6) AS last_5 FROM accounts WHERE len(latest) > 0"
STREAK_SQL = f"WITH {ACCOUNTS.strip()} SELECT account_id, outcome AS last_outcome, CAST(n AS BIGINT) AS streak_len FROM streaks"
OUTCOME_COUNTS_SQL = "SELECT return_cause, " + ", ".join(
    f"count(*) FILTER (WHERE {rule}) AS is_{name}" for name, rule in OUTCOMES.items()
) + " FROM v_history WHERE account_id > 0 GROUP BY 1"

DOUBLES = [
    "buyout_rate_money_win", "buyout_rate_money_90d", "buyout_rate_money_30d", "buyout_rate_items_win", "buyout_rate_orders_win",
    "buyout_rate_last_3", "buyout_rate_last_5", "buyout_rate_last_10", "buyout_rate_first_3", "buyout_trend",
    "no_show_share_of_delivered", "no_show_share_of_nonbuyout", "cancel_before_delivery_share", "no_show_gmv_share",
    "postpaid_share_win", "installment_share_win", "buyout_rate_postpaid", "buyout_rate_prepaid",
    "avg_ticket_win", "median_ticket_win", "std_ticket_win", "max_ticket_win", "avg_items_per_order_win",
]
