"""The corpus pipeline; its stages are in chronoloom/llm/pipeline.py."""

from chronoloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
