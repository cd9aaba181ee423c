"""Contact-centre analytics expressed as Spark DataFrame plans."""

from callstrata.settings import Settings, ValidationPeriod

__all__ = ["Settings", "ValidationPeriod"]
