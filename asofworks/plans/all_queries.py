"""Every query of the library outside the language-model subpackage."""

from __future__ import annotations

from asofworks.plans import binding_queries, composed_queries, governed_queries, graph_queries, identity_queries, metric_queries, panel_queries, period_queries, pivot_queries, price_queries, quarter_queries, registry_queries, screening_queries, selection_queries, setop_queries, source_queries, valuation_queries
from asofworks.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "binding_queries", "composed_queries", "governed_queries", "graph_queries", "identity_queries", "metric_queries", "panel_queries", "period_queries", "pivot_queries", "price_queries", "quarter_queries", "registry_queries", "screening_queries", "selection_queries", "setop_queries", "source_queries", "valuation_queries"]
