"""Period-cube analytics as plain Spark DataFrame plans."""

from cubeloom.spec import DEFAULT_SPEC, CubeSpec

__all__ = ["CubeSpec", "DEFAULT_SPEC"]
