"""All registered queries."""

from __future__ import annotations

from tabularium.checks import analysis, columns, declared, measures, nested, sources, tables  # noqa: F401
from tabularium.checks.registry import CHECKS

__all__ = ["CHECKS"]
