"""Fixed small weights for the scoring queries, from a rule, so that Spark and SQL use the same numbers.

The biases are no short decimals: a relu input of exactly zero has no single derivative, and rational inputs with
rational weights reach it.
"""

from __future__ import annotations

from flowgraph.operators.layers import ChebParams, GatParams, GcnParams
from flowgraph.plans.driver_tables import H

HIDDEN = 6
HEADS = 2
ORDER = 2


def weight(layer: int, tap: int, row: int, col: int) -> float:
    return ((5 * layer + 3 * tap + 2 * row + 7 * col) % 11 - 4) / 16 + 0.0125


def bias(layer: int, col: int) -> float:
    return ((3 * layer + 2 * col) % 5 - 1) / 32 + 0.0061803


def matrix(layer: int, tap: int, rows: int, cols: int) -> list[list[float]]:
    return [[weight(layer, tap, r, c) for c in range(cols)] for r in range(rows)]


def biases(layer: int, cols: int) -> list[float]:
    return [bias(layer, c) for c in range(cols)]


def gcn() -> GcnParams:
    return GcnParams([matrix(0, 0, H, HIDDEN), matrix(1, 0, HIDDEN, 1)], [biases(0, HIDDEN), biases(1, 1)])


def cheb() -> ChebParams:
    taps = range(ORDER + 1)
    return ChebParams(
        [[matrix(0, k, H, HIDDEN) for k in taps], [matrix(1, k, HIDDEN, 1) for k in taps]],
        [biases(0, HIDDEN), biases(1, 1)],
    )


def gat() -> GatParams:
    return GatParams(
        [matrix(0, a, H, HIDDEN) for a in range(HEADS)],
        [biases(a, HIDDEN) for a in range(HEADS)],
        matrix(1, 0, HIDDEN * HEADS, 1),
        biases(1, 1),
    )
