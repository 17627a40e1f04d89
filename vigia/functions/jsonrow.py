"""Row images as JSON text (F28), nulls kept as explicit JSON nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_json(*cols) -> Column:
    """to_json(struct(cols)) keeping null fields (Spark drops them by default)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
