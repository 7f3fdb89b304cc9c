"""A training corpus from raw documents, in five stages: see ``folio.llm.pipeline``."""

from folio.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
