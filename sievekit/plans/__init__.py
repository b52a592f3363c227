"""Multi-step plans built from the operators: global running totals and the
end-to-end flows (ingest, featurise, train)."""

from .cumulative import running_totals

__all__ = ["running_totals"]
