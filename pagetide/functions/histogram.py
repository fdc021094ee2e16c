"""Bucket edges for cumulative histograms."""

from __future__ import annotations


def exponential_edges(start: float, factor: float, count: int) -> list[float]:
    if start <= 0 or factor <= 1 or count < 1:
        raise ValueError("need start > 0, factor > 1 and count >= 1")
    return [start * factor**i for i in range(count)]


def linear_edges(start: float, width: float, count: int) -> list[float]:
    if width <= 0 or count < 1:
        raise ValueError("need width > 0 and count >= 1")
    return [start + width * i for i in range(count)]
