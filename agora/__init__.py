"""agora: marketplace analytics as Spark DataFrame builders.

Raw marketplace tables (orders, items, payments, reviews, products, customers,
sellers, geolocation, category names) flow through staging, enrichment, core
marts and analytics marts. Every builder is a pure ``DataFrame -> DataFrame``
function; :class:`agora.plans.pipeline.Pipeline` wires them together, shares
the order-grain table between its consumers and writes the marts.
"""

from agora.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
