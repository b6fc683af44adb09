"""Readers for comments and for finished results."""

from .comments import land_raw, read_comments_csv
from .landing import Landing, land_checked, landed, read_checked
from .results import read_result

__all__ = [
    "Landing",
    "land_checked",
    "land_raw",
    "landed",
    "read_checked",
    "read_comments_csv",
    "read_result",
]
