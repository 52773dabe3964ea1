"""Publishing of finished tables."""

from .publish import (
    Layout,
    Published,
    Staged,
    commit,
    discard,
    ensure_layer,
    publish,
    publish_all,
    read_commit,
    resolve,
    settle,
    stage,
    stage_all,
)

__all__ = [
    "Layout",
    "Published",
    "Staged",
    "commit",
    "discard",
    "ensure_layer",
    "publish",
    "publish_all",
    "read_commit",
    "resolve",
    "settle",
    "stage",
    "stage_all",
]
