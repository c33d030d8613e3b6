"""Sinks: CSV tables with fixed columns and formats, circle plans as JSON, a cached boundary."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed
from ..plans.collect import PLACE_COLUMNS
from .staged import DocumentSource, save

#: Columns of the cells table, in order.
CELL_COLUMNS = ("row", "col", "lon_center", "lat_center", "lon_left", "lon_right", "lat_bottom", "lat_top", "population_density")


def write_places(places: DataFrame, path: str) -> None:
    """CSV folder with the twelve columns, missing values empty, rows ended by CRLF."""
    out = places.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in PLACE_COLUMNS])
    out.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", lineSep="\r\n")


def write_cells(cells: DataFrame, path: str) -> None:
    """Coordinates with eight digits, densities with six."""
    out = cells.select(*[F.col(c).cast("string").alias(c) if c in ("row", "col") else fixed(F.col(c), 6 if c == "population_density" else 8).alias(c) for c in CELL_COLUMNS])
    out.write.mode("overwrite").csv(path, header=True)


def write_circles(circles: DataFrame, path: str) -> None:
    """JSON lines, the form for plans of any size."""
    circles.write.mode("overwrite").json(path)


#: A JSON array with a row on lines of its own, two spaces in, and a line feed at the end.
_ARRAY = {"head": "[", "first": "\n", "between": ",\n", "tail": "\n]\n", "empty": "]\n", "indent": "2"}


def circles_document(circles: DataFrame, path: str) -> int:
    """One JSON array, indented, ASCII, with a line feed at its end; tasks write its parts, which the commit joins."""
    return save(circles, DocumentSource, path, single="true", **_ARRAY)


def circles_documents(circles: DataFrame, folder: str) -> int:
    """A folder with a JSON array for each task that had rows, and a manifest."""
    return save(circles, DocumentSource, folder, suffix=".json", **_ARRAY)


def cached_boundary(path: str, settings: dict, make) -> dict:
    """A boundary document from ``path`` if it was made with these settings, else made anew and kept; failing to keep it is no error."""
    p = Path(path)
    try:
        found = json.loads(p.read_text())
        if found.get("properties", {}).get("settings") == settings:
            return found
    except (OSError, ValueError):
        pass
    made = make()
    made.setdefault("properties", {})["settings"] = settings
    try:
        p.write_text(json.dumps(made))
    except OSError:
        pass
    return made
