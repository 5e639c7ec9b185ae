"""Size guards for everything that is broadcast or inlined into a plan.

Only data whose size is bounded by operator parameters (k, z, L, number of
guesses) is ever broadcast; these helpers make that bound explicit and refuse
plans whose bound exceeds the budget instead of silently shipping a large table.
"""

from __future__ import annotations

# Budget for one broadcast relation / inlined literal, in bytes.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def point_bytes(dim: int) -> int:
    """Rough in-memory size of one (id, weight, array<double>[dim]) row."""
    return 8 * dim + 64


def check_broadcast_bound(rows_bound: int, row_bytes: int, what: str,
                          budget: int = MAX_BROADCAST_BYTES) -> None:
    need = int(rows_bound) * int(row_bytes)
    if need > budget:
        raise ValueError(
            f"{what}: up to {rows_bound} rows (~{need >> 20} MiB) would be broadcast, "
            f"over the {budget >> 20} MiB budget; lower the parameters that bound it")
