"""Registered queries over the lake, each with an independent SQL statement of the same result."""

from . import analytics, cleaning, quality  # noqa: F401
from .base import QUERIES  # noqa: F401
