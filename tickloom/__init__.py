"""Trade-stream analytics as PySpark DataFrame functions, in batch and on streams."""

from tickloom.params import Params

__all__ = ["Params"]
