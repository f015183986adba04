"""Directed events on circular coordinate spaces, computed with Spark DataFrames."""

from circlet.params import Params

__all__ = ["Params"]
