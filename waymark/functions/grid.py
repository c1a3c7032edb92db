"""Grid cells such that points within a given distance lie in the same or adjacent cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.distance import EARTH_RADIUS_KM, KM_PER_DEGREE, metric_function

# Cells are a hair larger than the distance, so rounding at an edge cannot part two points.
MARGIN = 1.001


class Grid:
    """Cells for one distance and metric, numbered by row ``y`` and column ``x``.

    Planar cells are squares. For the great-circle metric the rows are bands of latitude, and
    each band is cut into equal columns wide enough for its own latitude, numbered from the
    date line and closing on themselves.
    """

    def __init__(self, km: float, metric: str):
        metric_function(metric)
        if km <= 0:
            raise ValueError("the distance must be positive")
        self.km = km
        self.planar = metric == "planar"
        per_degree = KM_PER_DEGREE if self.planar else math.radians(EARTH_RADIUS_KM)
        self.height = km * MARGIN / per_degree

    def row(self, lat: Column) -> Column:
        return F.floor(lat / self.height)

    def _columns_in_row(self, row: Column) -> Column:
        # The narrowest place that two points may share from this row and the rows beside it.
        farthest = F.least(
            F.lit(90.0), (F.greatest(F.abs(row), F.abs(row + 1)) + 1) * self.height
        )
        half_angle = math.sin(min(self.km / (2 * EARTH_RADIUS_KM), math.pi / 2))
        ratio = F.least(F.lit(1.0), half_angle / F.cos(F.radians(farthest)))
        width = F.degrees(2 * F.asin(ratio)) * MARGIN
        return F.greatest(F.lit(1), F.floor(F.lit(360.0) / width))

    def column(self, lon: Column, row: Column) -> Column:
        if self.planar:
            return F.floor(lon / self.height)
        count = self._columns_in_row(row)
        turned = F.pmod(lon + 180.0, F.lit(360.0))
        return F.least(F.floor(turned * count / 360.0), count - 1)

    @staticmethod
    def _number(row: Column, column: Column) -> Column:
        # Row and column side by side in one long, which hashes and sorts as a plain number.
        return row * 2**32 + column

    def cell(self, lat: Column, lon: Column) -> Column:
        row = self.row(lat)
        return self._number(row, self.column(lon, row))

    def part(self, lat: Column, lon: Column, parts: int) -> Column:
        """Number of the part of its cell that holds a point, cut ``parts`` times each way."""
        y = F.floor(lat * parts / self.height)
        if self.planar:
            return self._number(y, F.floor(lon * parts / self.height))
        turned = F.pmod(lon + 180.0, F.lit(360.0))
        count = self._columns_in_row(self.row(lat))
        return self._number(y, F.floor(turned * count * parts / 360.0))

    def _moved(self, row: Column, column: Column, step: int) -> Column:
        if self.planar or step == 0:
            return column + step
        return F.pmod(column + step, self._columns_in_row(row))

    def cells_around(self, lat: Column, lon: Column, forward: bool = False) -> Column:
        """Array of the cells that can hold a point within the distance.

        ``forward`` leaves out those behind (rows below, and the column before in the same
        row): of two points in different cells at least one then has the other's cell.
        """
        own = self.row(lat)
        cells = []
        for up in (0, 1) if forward else (-1, 0, 1):
            row = own + up
            column = self.column(lon, row)
            for step in (0, 1) if forward and up == 0 else (-1, 0, 1):
                cells.append(self._number(row, self._moved(row, column, step)))
        around = F.array(*cells)
        # Near a pole a band has so few columns that steps meet again.
        return around if self.planar else F.array_distinct(around)
