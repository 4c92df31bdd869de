"""Spark engine for building and querying rRNA operon databases."""

from rrnlake.config import GTDB, NCBI, OperonRules, TaxonomySystem
from rrnlake.session import build_session

__all__ = ["GTDB", "NCBI", "OperonRules", "TaxonomySystem", "build_session"]
