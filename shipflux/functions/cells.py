"""H3 cell arithmetic on BIGINT cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of a 64-bit H3 index.
RESOLUTION_SHIFT = 52
FINEST_RESOLUTION = 15
BITS_PER_DIGIT = 3


def parent_cell(cell: Column, resolution: int) -> Column:
    """The cell that contains `cell` at a coarser resolution.

    The resolution field is replaced and every finer digit is set to 7 (unused).
    """
    clear = ~(FINEST_RESOLUTION << RESOLUTION_SHIFT)
    unused = (1 << (BITS_PER_DIGIT * (FINEST_RESOLUTION - resolution))) - 1
    fill = (resolution << RESOLUTION_SHIFT) | unused
    return cell.bitwiseAND(F.lit(clear)).bitwiseOR(F.lit(fill))
