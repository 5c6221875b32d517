"""DataFrame operators: cleansing, dedup, models, lookups, reports, data quality."""

from fareline.operators import cleanse, dedup, lookups, models, quality, reports

__all__ = ["cleanse", "dedup", "lookups", "models", "quality", "reports"]
