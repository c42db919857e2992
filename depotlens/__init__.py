"""depotlens: Spark-native batch analytics for distribution data."""

from depotlens.session import ensure_checkpoint_dir, get_spark

__all__ = ["ensure_checkpoint_dir", "get_spark"]
