from seriesloom.sources.points import (
    points_from_double_arrays,
    points_from_map,
    points_from_rows,
    points_from_series,
    points_from_string_arrays,
    points_from_structs,
    points_from_wide,
    points_typed,
    union_points,
)

__all__ = [
    "points_from_double_arrays", "points_from_map", "points_from_rows", "points_from_series",
    "points_from_string_arrays", "points_from_structs", "points_from_wide", "points_typed", "union_points",
]
