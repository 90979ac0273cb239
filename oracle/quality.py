"""The failure count of each declared check, as DuckDB SQL."""

from __future__ import annotations

from tradewind.plans.checks import CHECKS, Check


def _relation(layer: str, name: str) -> str:
    return f"src_{name}" if layer == "sources" else name


def _literals(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _failures(k: Check) -> str:
    t = _relation(k.layer, k.model)
    o = _relation(k.layer, k.other) if k.other else ""
    col = k.column
    match k.kind:
        case "not_null":
            return f"select count(*) from {t} where {col} is null"
        case "accepted_values":
            return f"select count(*) from {t} where {col} not in ({_literals(k.values)})"
        case "not_negative":
            return f"select count(*) from {t} where {col} < 0"
        case "expression_is_true":
            return f"select count(*) from {t} where not ({k.rule})" + (f" and ({k.where})" if k.where else "")
        case "unique":
            return f"select count({col}) from (select {col} from {t} group by all having count(*) > 1)"
        case "unique_combination":
            cols = ", ".join(col.split())
            return f"select count(*) from (select {cols} from {t} group by all having count(*) > 1)"
        case "relationships":
            return (
                f"select count(*) from {t} where {col} is not null and {col} not in "
                f"(select {k.other_column} from {o} where {k.other_column} is not null)"
            )
        case "equal_rowcount":
            return f"select ((select count(*) from {t}) <> (select count(*) from {o}))::bigint"
        case "sums_match":
            return (
                f"select (abs((select sum({col}) from {t}) - (select sum({k.other_column}) from {o})) "
                f"> {k.tolerance})::bigint"
            )
        case "lifecycle_out_of_order":
            return (
                f"select count(*) from {t} where order_approved_at < order_purchase_timestamp "
                "or order_delivered_carrier_date < order_purchase_timestamp "
                "or order_delivered_customer_date < order_delivered_carrier_date"
            )
        case "customers_off_order_count":
            return (
                f"select count(*) from {t} c where lifetime_order_count is distinct from "
                f"(select count(*) from {o} f where f.customer_key = c.customer_key)"
            )
        case "orphan_items":
            return f"select count(distinct order_id) from {t} where order_id not in (select order_id from {o})"
        case "unreconciled_orders":
            return (
                f"select count(*) from {t} join (select order_id, sum(item_total) as s from {o} group by all) "
                "using (order_id) where abs(order_total - s) > 0.01"
            )
    raise ValueError(k.kind)


def summary_sql(layer: str) -> str:
    return " union all ".join(
        f"select '{k.name}' as test, '{k.model}' as model, ({_failures(k)})::bigint as failures"
        for k in CHECKS
        if k.layer == layer
    )
