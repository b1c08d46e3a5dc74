"""All queries of the core, by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbforge.operators import packed
from kbforge.plans import hybrid_queries, registry, source_queries, table_queries, text_queries, vector_queries  # noqa: F401  (registration)
from kbforge.plans.registry import Tables, query


@query("p3_found")
def p3_found(t: Tables) -> DataFrame:
    """A source is what the papers' ids are made by: the archive of an old-style id (archive/number), the month of a
    new-style one (month.number)."""
    source = F.regexp_extract("paper_id", r"^([^/.]*)[/.]", 1)
    return packed.split_packed(t.ts_arxiv, "id", (packed.NAMES, packed.CODES), source)


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
