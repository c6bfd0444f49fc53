"""Equipment-health analytics as PySpark DataFrame operators."""

from millwatch.config import DEFAULT_RULE, RiskRule, Weights

__all__ = ["DEFAULT_RULE", "RiskRule", "Weights"]
