"""tickerloom: equity price and dividend analytics as plain Spark DataFrame plans."""

from tickerloom.settings import AnalysisSettings

__all__ = ["AnalysisSettings"]
