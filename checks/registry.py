"""All registered queries."""

from checks import io_queries  # noqa: F401 - registers its queries
from checks.queries import QUERIES

__all__ = ["QUERIES"]
