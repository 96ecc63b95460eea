"""Condition event streams with Spark.

Raw captures of live JSON feeds become uniform envelopes, and a declarative
spec filters, reshapes, deduplicates, tags, thins out and batches them, on
batch DataFrames and on Structured Streaming alike.
"""

from millrace.envelope import ENVELOPE
from millrace.plans.pipeline import chain, run
from millrace.plans.spec import PipelineSpec
from millrace.session import configure

__all__ = ["ENVELOPE", "PipelineSpec", "chain", "configure", "run"]
