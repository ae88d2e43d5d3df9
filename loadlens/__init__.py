"""Spark-native smart-meter load analytics (batch and streaming).

Entry points: ``loadlens.plans.catalog.QUERIES`` (every registered query),
``loadlens.jobs.energy`` (the processor and accuracy jobs), and the operator
modules under ``loadlens.operators`` for building your own plans.
"""

__version__ = "0.1.0"
