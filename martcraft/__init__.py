"""martcraft: a transaction star schema (staging, dimensions, fact, monthly aggregate, checks) on Spark."""
from martcraft.config import DEFAULT_BANDS, Bands, Ladder, QualityParams, TierLadder
from martcraft.operators.catalog import declared_checks
from martcraft.operators.cleaning import clean_transactions, null_profile, reject_counts
from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.quality import failing_rows, freshness, load_profile, run_checks
from martcraft.operators.staging import stage_transactions, valid_transactions
from martcraft.plans.rebuild import check_all, read_star, rebuild
from martcraft.plans.refresh import append_incremental, read_target
from martcraft.session import get_session, scale_conf
from martcraft.sources.raw import read_raw_csv

__version__ = "0.1.0"

__all__ = [
    "DEFAULT_BANDS", "Bands", "Ladder", "QualityParams", "TierLadder", "declared_checks", "clean_transactions",
    "null_profile", "reject_counts", "dim_customers", "dim_products", "fact_transactions", "monthly_sales",
    "failing_rows", "freshness", "load_profile", "run_checks", "stage_transactions", "valid_transactions",
    "check_all", "rebuild", "read_star", "append_incremental", "read_target", "get_session", "scale_conf", "read_raw_csv",
]
