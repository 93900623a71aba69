"""Job-market analytics as composable Spark DataFrame operators."""

from hiremart.config import Config

__all__ = ["Config"]
