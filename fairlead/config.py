"""[Z1] Settings from the environment; arguments of functions and of the command line go before them."""

from __future__ import annotations

import os


def cache_dir() -> str:
    return os.environ.get("FAIRLEAD_CACHE_DIR", "cache")


def site_dir() -> str:
    return os.environ.get("FAIRLEAD_SITE_DIR", "site")


def remote_url() -> str:
    return os.environ.get("FAIRLEAD_REMOTE_URL", "")


def remote_key() -> str:
    """Never logged or written."""
    return os.environ.get("FAIRLEAD_REMOTE_KEY", "")
