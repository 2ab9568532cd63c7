"""Column-name rules (metadata only; no Spark job)."""

from __future__ import annotations


def standardized_name(name: str) -> str:
    """Strip the ends, lowercase, and turn spaces and hyphens into underscores."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")
