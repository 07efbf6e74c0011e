"""The declared checks of the modelled project, per table."""
from __future__ import annotations

from martcraft.config import DEFAULT_BANDS, Bands, QualityParams
from martcraft.operators.quality import (
    Check,
    accepted_range,
    accepted_values,
    expression_is_true,
    not_null,
    relationships,
    unique,
    unique_combination,
)

SOURCE = "cleaned_customer_transactions"
STAGING = "stg_customer_transactions"
DIM_CUSTOMERS = "dim_customers"
DIM_PRODUCTS = "dim_products"
FACT = "fact_transactions"
MONTHLY = "agg_monthly_sales"


def declared_checks(bands: Bands = DEFAULT_BANDS, params: QualityParams = QualityParams(),
                    audit: bool = True) -> list[Check]:
    """All 147 declared checks (audit-column not_null checks only when ``audit``)."""
    nn = lambda m, cols: [not_null(m, c) for c in cols]
    checks: list[Check] = []
    # Which columns each declared check covers.
    checks += nn(SOURCE, ["transaction_id", "transaction_date", "product_id", "price", "tax"])
    checks += [unique(STAGING, "transaction_id")]
    checks += nn(STAGING, ["transaction_id", "product_id", "transaction_date", "transaction_month", "transaction_year",
                           "transaction_quarter", "month_number", "month_name", "day_name", "product_name",
                           "unit_price", "tax_amount", "is_valid_quantity", "is_valid_price",
                           "is_valid_transaction"] + (["transformed_at"] if audit else []))
    checks += [accepted_values(STAGING, c, [True, False])
               for c in ("is_valid_quantity", "is_valid_price", "is_valid_transaction")]
    checks += [unique(DIM_CUSTOMERS, "customer_key"), unique(DIM_CUSTOMERS, "customer_id")]
    checks += nn(DIM_CUSTOMERS, ["customer_key", "customer_id", "total_transactions", "unique_transaction_days",
                                 "years_active", "months_active", "unique_products_purchased",
                                 "first_transaction_date", "last_transaction_date", "days_since_last_purchase",
                                 "customer_age_days", "total_lifetime_value", "avg_transaction_value",
                                 "min_transaction_value", "max_transaction_value", "total_units_purchased",
                                 "value_segment", "frequency_segment", "recency_segment", "aov_tier",
                                 "customer_tier"] + (["created_at", "updated_at"] if audit else []))
    checks += [
        accepted_values(DIM_CUSTOMERS, "value_segment", bands.value_segment.labels),
        accepted_values(DIM_CUSTOMERS, "frequency_segment", bands.frequency_segment.labels),
        accepted_values(DIM_CUSTOMERS, "recency_segment", bands.recency_segment.labels),
        accepted_values(DIM_CUSTOMERS, "aov_tier", bands.aov_tier.labels),
        accepted_values(DIM_CUSTOMERS, "customer_tier", bands.customer_tier.labels),
    ]
    checks += [unique(DIM_PRODUCTS, "product_key"), unique(DIM_PRODUCTS, "product_id")]
    checks += nn(DIM_PRODUCTS, ["product_key", "product_id", "product_name", "total_transactions",
                                "unique_transaction_days", "unique_customers", "first_sale_date", "last_sale_date",
                                "days_since_last_sale", "total_units_sold", "total_revenue", "revenue_per_customer",
                                "avg_unit_price", "min_unit_price", "max_unit_price", "price_tier",
                                "avg_quantity_per_transaction", "min_quantity_per_transaction",
                                "max_quantity_per_transaction", "revenue_segment", "volume_segment"]
                 + (["created_at", "updated_at"] if audit else []))
    checks += [
        accepted_values(DIM_PRODUCTS, "price_tier", bands.price_tier.labels),
        accepted_values(DIM_PRODUCTS, "revenue_segment", bands.revenue_segment.labels),
        accepted_values(DIM_PRODUCTS, "volume_segment", bands.volume_segment.labels),
    ]
    checks += [unique(FACT, "transaction_key")]
    checks += nn(FACT, ["transaction_key", "customer_fk", "product_fk", "transaction_date", "transaction_month",
                        "transaction_year", "transaction_quarter", "units_sold", "gross_amount", "tax_amount",
                        "net_amount", "revenue_excluding_tax", "unit_price", "customer_tier",
                        "customer_value_segment", "product_name", "product_price_tier", "product_revenue_segment"]
                 + (["created_at"] if audit else []))
    checks += [
        relationships(FACT, "customer_fk", DIM_CUSTOMERS, "customer_key"),
        relationships(FACT, "product_fk", DIM_PRODUCTS, "product_key"),
        accepted_values(FACT, "transaction_quarter", [1, 2, 3, 4]),
    ]
    checks += nn(MONTHLY, ["customer_fk", "transaction_month", "transaction_year", "transaction_quarter",
                           "transaction_count", "unique_products_purchased", "total_units",
                           "avg_units_per_transaction", "monthly_gross_revenue", "monthly_tax",
                           "monthly_net_revenue", "monthly_revenue_excluding_tax", "avg_revenue_per_transaction",
                           "avg_unit_price", "min_unit_price", "max_unit_price", "customer_tier",
                           "customer_value_segment"] + (["refreshed_at"] if audit else []))
    checks += [
        relationships(MONTHLY, "customer_fk", DIM_CUSTOMERS, "customer_key", severity="warn"),
        accepted_range(MONTHLY, "transaction_year", params.year_min, params.year_max),
        accepted_values(MONTHLY, "transaction_quarter", [1, 2, 3, 4]),
    ]
    ex = lambda col, expr, sev="error", tag="": expression_is_true(
        MONTHLY, expr, column=col, severity=sev, tag=tag)
    checks += [
        ex("transaction_count", "transaction_count >= 1"),
        ex("unique_products_purchased", "unique_products_purchased >= 1", tag="min"),
        ex("unique_products_purchased", "unique_products_purchased <= transaction_count", "warn", tag="le_count"),
        ex("total_units", "total_units >= 0"),
        ex("avg_units_per_transaction", "avg_units_per_transaction > 0"),
        ex("monthly_gross_revenue", "monthly_gross_revenue >= 0"),
        ex("monthly_tax", "monthly_tax >= 0"),
        ex("monthly_net_revenue", "monthly_net_revenue >= 0"),
        ex("monthly_revenue_excluding_tax", "monthly_revenue_excluding_tax >= 0"),
        ex("avg_revenue_per_transaction", "avg_revenue_per_transaction >= 0"),
        ex("avg_unit_price", "avg_unit_price > 0"),
        ex("min_unit_price", "min_unit_price > 0"),
        ex("max_unit_price", "max_unit_price > 0", tag="positive"),
        ex("max_unit_price", "max_unit_price >= min_unit_price", tag="ge_min"),
        ex("revenue_growth_pct", "revenue_growth_pct IS NULL OR (revenue_growth_pct >= -100)", "warn"),
        ex("transaction_growth_pct", "transaction_growth_pct IS NULL OR (transaction_growth_pct >= -100)", "warn"),
        ex(None, "ABS(monthly_net_revenue - (monthly_gross_revenue + monthly_tax)) < 0.01", tag="net_is_gross_plus_tax"),
        ex(None, "monthly_revenue_excluding_tax <= monthly_net_revenue", "warn", tag="ex_tax_le_net"),
        unique_combination(MONTHLY, ("customer_fk", "transaction_month")),
    ]
    return checks
