"""Business-document analytics on Spark.

`docketmill.plans.pipeline` runs everything; the modules under `operators` are
its stages, each a function from DataFrame to DataFrame.
"""

from docketmill.rules import DEFAULT_RULES, RuleSet

__all__ = ["DEFAULT_RULES", "RuleSet"]
