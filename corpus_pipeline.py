"""The corpus pipeline: documents without toxic rows, repeated lines, near duplicates and benchmark items, as token ids.

The stages themselves are part of the package (``tastemill.llm.stages``), which works without this file.
"""

from tastemill.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
