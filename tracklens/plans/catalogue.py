"""All queries of the track operators with their SQL."""

from __future__ import annotations

import importlib

_MODULES = ("timelines", "identities", "geometry", "selections", "frame_tracks", "streams", "archived", "face_queries", "whole_manifest")

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name in _MODULES:
    _module = importlib.import_module(f".{_name}", __package__)
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
