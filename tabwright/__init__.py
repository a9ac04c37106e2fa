"""Operators for the life of a tabular classification model, as Spark jobs.

Every operator is a function from ``DataFrame`` to ``DataFrame``; fitted state is a
``PipelineModel``; logs, aliases and decisions are ordinary tables.
"""

from tabwright.spec import FeatureLookup, FeatureSpec

__all__ = ["FeatureLookup", "FeatureSpec"]
