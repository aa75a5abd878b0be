"""basketlens: online-shop behaviour analytics as composable Spark jobs."""

from basketlens.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
