from __future__ import annotations

import pytest

# Names of columns that operators use inside.
CLASHING = ["_id", "digest", "copies", "_copies", "_rows", "_row", "_times", "_dropped", "_digest", "size", "key", "before", "node", "batch", "id"]
DOCS = "doc_id bigint, text string, source string, " + ", ".join(f"{name} string" for name in CLASHING)


@pytest.fixture
def docs(spark):
    """Makes documents of (id, text) or (id, text, source), with columns whose names clash with inner ones."""

    def make(*rows):
        rows = [(row[0], row[1], row[2] if len(row) > 2 else "s", f"x{i % 2}", "d", *[None] * (len(CLASHING) - 2)) for i, row in enumerate(rows)]
        return spark.createDataFrame(rows, DOCS)

    return make
