"""Job plans: the month job and the query catalogue."""

from fareline.plans.month_job import MonthJob, backfill, build_month, build_models, cleanse_and_load

__all__ = ["MonthJob", "backfill", "build_month", "build_models", "cleanse_and_load"]
