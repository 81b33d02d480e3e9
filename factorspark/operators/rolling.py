"""Trailing row-window sums over ordered groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rolling_sums(
    df: DataFrame,
    over: str,
    terms: Mapping[str, int],
    widths: Sequence[int],
    alongside: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace every column of ``terms`` by its sum over trailing rows.

    ``over`` is the window (``PARTITION BY .. ORDER BY ..``) and ``terms`` maps a column without
    NULLs to the number of rows to sum. A sliding frame would add up all of those rows again for
    every output row; here a sum over ``n * k`` rows is put together from ``n`` adjacent sums over
    ``k`` rows, fetched with ``lag``. ``widths`` lists the row counts on the way up, each dividing
    the next, and must contain every requested one.

    ``alongside`` adds further columns, as SQL over the same window, in the pass of the first level.

    Nothing is ever subtracted, so one extreme value disturbs only the windows that contain it
    (running totals would carry its rounding error to the end of the series). All levels use the
    same partitioning and order, hence one exchange and one sort in total.
    """
    chain = [1, *widths]
    if any(wide % narrow for narrow, wide in pairwise(chain)):
        raise ValueError(f"each width must divide the next one: {list(widths)}")
    if not set(terms.values()) <= set(chain):
        raise ValueError(f"requested widths {sorted(set(terms.values()))} are not all in {chain}")

    wider = {name: F.expr(sql) for name, sql in (alongside or {}).items()}
    for narrow, wide in pairwise(chain):
        for column, rows in terms.items():
            if rows >= wide:
                blocks = [column, *(f"lag({column}, {n}, 0) OVER ({over})" for n in range(narrow, wide, narrow))]
                wider[column] = F.expr(" + ".join(blocks))
        df = df.withColumns(wider)
        wider = {}
    return df
