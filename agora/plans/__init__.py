"""Model builders by layer, and the pipeline that wires them."""

from agora.plans.pipeline import MARTS, Pipeline, from_testdata

__all__ = ["MARTS", "Pipeline", "from_testdata"]
