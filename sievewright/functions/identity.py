"""Row identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions.text import backticked


def row_hash(names, null_safe: bool = False) -> Column:
    """SHA-256 over the columns as text, joined by ``|``.

    NULLs are skipped by the join, so ``(a, NULL, b)`` and ``(a, b, NULL)`` hash alike;
    ``null_safe=True`` hashes a JSON record that keeps every position.
    """
    texts = [f"cast({backticked(n)} AS string)" for n in names]
    if null_safe:
        pairs = ", ".join(f"'f{i}', {text}" for i, text in enumerate(texts))
        return F.expr(f"sha2(to_json(named_struct({pairs}), map('ignoreNullFields', 'false')), 256)")
    return F.expr(f"sha2(concat_ws('|', {', '.join(texts)}), 256)")
