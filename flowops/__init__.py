"""flowops: batch analytics on wide, labelled record tables, written as Spark DataFrame operators."""

from flowops.spec import FLOW, Spec

__all__ = ["FLOW", "Spec"]
