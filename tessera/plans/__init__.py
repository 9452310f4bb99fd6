"""Named queries over the test tables, each with DuckDB SQL for the same rows where SQL can express it."""

from tessera.plans import archives, audit, batching, files, queue, reading, relational, sections, stories, texts  # noqa: F401 - they register their queries
from tessera.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
