"""Stages that are built once per session and set of input files."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import TypeVar

from pyspark.sql import SparkSession

from orderloom.sources import files

Result = TypeVar("Result")


def stage(build: Callable[[SparkSession, str], Result]) -> Callable[[SparkSession, str], Result]:
    """Keep what ``build`` returns until the session or the files under the table folder change.

    Only the last result per session and folder is kept, so changed tables give a new answer.
    """
    held: dict[tuple[SparkSession, str], tuple[tuple, Result]] = {}

    def peek(spark: SparkSession, sf: str) -> Result | None:
        """What is kept for the files as they are; builds nothing."""
        old = held.get((spark, sf))
        return old[1] if old and old[0] == files.state(spark, sf) else None

    @wraps(build)
    def get(spark: SparkSession, sf: str) -> Result:
        state = files.state(spark, sf)
        old = held.get((spark, sf))
        if old is None or old[0] != state:
            held[spark, sf] = old = (state, build(spark, sf))
        return old[1]

    get.held = peek
    return get
