"""Scalar column functions (inventory section H)."""

from hourglass.functions.scalar import *  # noqa: F401,F403
