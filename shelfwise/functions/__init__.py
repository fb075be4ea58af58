from shelfwise.functions.scalar import (
    complete,
    cosine,
    epoch_seconds,
    half_star,
    rounded,
    split_list,
    vector_dot,
    year_month,
)

__all__ = [
    "complete",
    "cosine",
    "epoch_seconds",
    "half_star",
    "rounded",
    "split_list",
    "vector_dot",
    "year_month",
]
