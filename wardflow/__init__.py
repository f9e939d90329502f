"""wardflow: cohort and 30-day-return feature engine on Spark DataFrames."""

from wardflow.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
