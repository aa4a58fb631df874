"""featureflow: feature, scoring and model-monitoring operators as Spark DataFrame plans.

Entry points: ``featureflow.session.build_session`` / ``configure``;
operators in ``featureflow.operators``; column builders in ``featureflow.functions``;
sources and sinks in ``featureflow.sources``; stream forms in ``featureflow.streaming``.
"""

__version__ = "0.1.0"
