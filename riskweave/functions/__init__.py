"""Column-level building blocks (JVM-side expressions only)."""
from .exprs import *  # noqa: F401,F403
