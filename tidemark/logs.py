"""Logging: set up once, and never over a host's own handlers."""

from __future__ import annotations

import logging
import os
import sys


def get_logger(name: str, level: str | None = None) -> logging.Logger:
    """A named logger below the package's; the level is the argument's, LOG_LEVEL's or INFO. Calls after the first change nothing but the level asked for."""
    package, root = logging.getLogger("tidemark"), logging.getLogger()
    if not root.handlers:
        handler = logging.StreamHandler(sys.stdout)
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s", datefmt="%Y-%m-%d %H:%M:%S"))
        root.addHandler(handler)
    if level or package.level == logging.NOTSET:
        package.setLevel(getattr(logging, (level or os.environ.get("LOG_LEVEL", "INFO")).upper(), logging.INFO))
    return logging.getLogger(name if name.startswith("tidemark") else f"tidemark.{name}")
