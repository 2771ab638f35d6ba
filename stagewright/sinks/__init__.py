"""Writers. Each runs one job."""

from stagewright.sinks.staging import stage
from stagewright.sinks.warehouse import write_table

__all__ = ["stage", "write_table"]
