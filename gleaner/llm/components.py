"""Connected components, shared with the search operators."""

from gleaner.functions.components import components

__all__ = ["components"]
