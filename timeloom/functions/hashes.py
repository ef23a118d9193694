"""Difference hashes of grids as SQL expressions: ``"<cols>x<rows>:<hex>"``, two bits for each pair of neighbours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distances are scaled to 64; a hash has about 128 cells; flatter pairs than 2 grey levels set no bit.
MAX_DISTANCE = 64
TARGET_CELLS = 128
FLAT = 2


def grid_for(height: Column, width: Column) -> Column:
    """struct(cols, rows) of about TARGET_CELLS nearly square cells for a region of this size."""
    aspect = F.greatest(width / F.greatest(height, F.lit(1)), F.lit(1e-6))
    rows = F.greatest(F.lit(1), F.bround(F.sqrt(F.lit(float(TARGET_CELLS)) / aspect)).cast("int"))
    return F.struct(F.greatest(F.lit(2), F.bround(TARGET_CELLS / rows).cast("int")).alias("cols"), rows.alias("rows"))


def difference_hash(grid: Column, cols: int, rows: int, flat: float = FLAT) -> Column:
    """Hash of a row-major array of ``rows`` x (``cols`` + 1) cell means: first the brighter bits, then the darker."""
    wide, bits = cols + 1, 2 * cols * rows
    deltas = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(rows - 1)),
            lambda r: F.zip_with(F.slice(grid, r * wide + 2, cols), F.slice(grid, r * wide + 1, cols), lambda b, a: b - a),
        )
    )
    padded = _let(
        deltas,
        lambda d: F.concat(F.transform(d, lambda x: (x > flat).cast("int")), F.transform(d, lambda x: (x < -flat).cast("int")), F.array_repeat(F.lit(0), -bits % 8)),
    )
    nibble = lambda p, i: F.lower(F.hex(sum(F.get(p, i * 4 + k) * (8 >> k) for k in range(4)).cast("bigint")))
    text = _let(padded, lambda p: F.array_join(F.transform(F.sequence(F.lit(0), F.lit((bits + 7) // 8 * 2 - 1)), lambda i: nibble(p, i)), ""))
    return F.concat(F.lit(f"{cols}x{rows}:"), text)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def grid_bits(grid: Column, available: Column) -> Column:
    """Bits a ``"<cols>x<rows>"`` grid carries, at most ``available``; 0 where it cannot be read."""
    cols, rows = (F.get(F.split(grid, "x"), F.lit(i)).try_cast("int") for i in (0, 1))
    return F.coalesce(F.least(cols * rows * 2, available), F.lit(0))


def hamming_distance(left: Column, right: Column) -> Column:
    """Differing bits of two hashes scaled to MAX_DISTANCE; the maximum where they cannot be compared."""
    grid_a, grid_b = F.substring_index(left, ":", 1), F.substring_index(right, ":", 1)
    hex_a, hex_b = F.substring_index(left, ":", -1), F.substring_index(right, ":", -1)
    places = F.sequence(F.lit(1), F.greatest(F.length(hex_a), F.lit(1)), F.lit(8))
    chunk = lambda h, i: F.conv(F.substr(h, i, F.lit(8)), 16, 10).cast("bigint")
    differing = F.aggregate(F.transform(places, lambda i: F.bit_count(chunk(hex_a, i).bitwiseXOR(chunk(hex_b, i)))), F.lit(0), lambda s, x: s + x)
    total = grid_bits(grid_a, F.length(hex_a) * 4)
    comparable = (
        (left != "") & (right != "") & (grid_a == grid_b) & (F.length(hex_a) == F.length(hex_b)) & (F.length(hex_a) % 2 == 0)
        & hex_a.rlike("^[0-9a-fA-F]+$") & hex_b.rlike("^[0-9a-fA-F]+$") & (total > 0)
    )
    return F.when(F.coalesce(comparable, F.lit(False)), F.bround(MAX_DISTANCE * differing / total).cast("int")).otherwise(MAX_DISTANCE)


def combined_distance(band: Column, full_frame: Column, weight: float) -> Column:
    return F.bround(band + weight * full_frame, 4)
