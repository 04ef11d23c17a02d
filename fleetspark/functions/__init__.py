"""Column-level functions: flags, scores, stamps."""

from . import flags, scores, stamps  # noqa: F401
