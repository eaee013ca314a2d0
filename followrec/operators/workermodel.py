"""Models held by a Python worker: loaded once per process, from a file Spark shipped."""

from __future__ import annotations

import threading
from typing import Callable

_models: dict[str, Callable] = {}
_lock = threading.Lock()


def loaded(name: str, load: Callable[[str], Callable]) -> Callable:
    """The predictor of the shipped file `name`; `load` runs on the first call only."""
    from pyspark import SparkFiles

    path = SparkFiles.get(name)
    with _lock:
        if path not in _models:
            _models[path] = load(path)
    return _models[path]
