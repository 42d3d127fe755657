"""File sources; register(spark) makes the formats known to a session."""

from __future__ import annotations


def register(spark) -> None:
    from .las import LasSource
    from .ply import PlySource

    for source in (LasSource, PlySource):
        spark.dataSource.register(source)
