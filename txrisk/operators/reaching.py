"""Rows of the groups that may be large enough, found by a count-min sketch before the groups are summed.

A sketch has ``lines`` lines of ``2 ** bits`` cells. A group adds its rows to one cell of each line, so that a cell is never below
any of its groups: a group whose cell in some line is under the floor is under it as well. Partial sums of the cells are built
before the shuffle, whatever the number of groups. A line's cells that reach the floor are at most ``2 ** bits`` numbers, which are broadcast.

It pays where most rows belong to groups under the floor, and only if a cell holds far less than the floor of other groups' rows:
``rows / 2 ** bits`` should be a quarter of the floor or less. With less room the same groups are found, but fewer rows are ruled out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.sources.workspace import stage

MOST_BITS = 20
LINES = 4


def bits_for(n_rows: int, floor: int) -> int:
    """Enough for cells of a quarter of the floor, up to :data:`MOST_BITS`."""
    wanted = 4 * n_rows // max(1, floor)
    return max(4, min(MOST_BITS, wanted.bit_length()))


def _cell(key: str, line: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(line)), 64 - bits)


def full_cells(rows: DataFrame, key: str, floor: int, measure: str = "n_tx", bits: int = MOST_BITS, lines: int = LINES) -> DataFrame:
    """``line, cell`` of the sketch's cells that reach the floor, written to the shared folder."""
    each = F.array(*[F.struct(F.lit(i).alias("line"), _cell(key, i, bits).alias("cell")) for i in range(lines)])
    cells = rows.select(F.col(measure).alias("n"), F.inline(each)).groupBy("line", "cell").agg(F.sum("n").alias("n"))
    return stage(cells.filter(F.col("n") >= floor).select("line", "cell"), "full-cells")


def reaching(rows: DataFrame, key: str, floor: int, measure: str = "n_tx", bits: int = MOST_BITS, lines: int = LINES) -> DataFrame:
    """The rows whose group by ``key`` may have ``floor`` or more of ``measure``, which must not be negative.

    All rows of every group that has as many are kept, and some of others. NULL is a group. Empty rows give empty rows. ``rows`` is read
    twice; a column ``reaching_cell`` is an error.
    """
    if not 1 <= bits <= MOST_BITS:
        raise ValueError(f"bits must be from 1 to {MOST_BITS}")
    if "reaching_cell" in [name.lower() for name in rows.columns]:
        raise ValueError("the rows have a column reaching_cell")
    full, kept = full_cells(rows, key, floor, measure, bits, lines), rows
    for line in range(lines):
        of_line = F.broadcast(full.filter(F.col("line") == line).select(F.col("cell").alias("reaching_cell")))
        kept = kept.join(of_line, _cell(key, line, bits) == F.col("reaching_cell"), "left_semi")
    return kept
