"""Whole jobs built from the operators."""

from daybook.plans.daily_model import daily_model, model_from_daily
from daybook.plans.daily_run import RunResult, add_exports, ingest_ads, ingest_orders, run
from daybook.plans.reporting import (
    load_model,
    model_date_range,
    model_exists,
    period_kpis,
    run_summary,
    with_roas_bands,
)

__all__ = [
    "RunResult",
    "add_exports",
    "daily_model",
    "ingest_ads",
    "ingest_orders",
    "load_model",
    "model_date_range",
    "model_exists",
    "model_from_daily",
    "period_kpis",
    "run",
    "run_summary",
    "with_roas_bands",
]
