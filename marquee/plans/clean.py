"""The clean pipeline as one lazy plan.

Source order: hoist credits, drop, flatten, type, null rules, dedupe on id,
id/title filter, released filter, non-null filter, final projection.  The
only shuffle is the dedupe; nothing is executed until the caller acts
(unless checkpoints are asked for).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from marquee.config import DEFAULTS, Settings
from marquee.operators import clean as C
from marquee.plans.publish import checkpoint

log = logging.getLogger(__name__)


def flattened(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return (raw.transform(C.hoist_credits)
            .transform(C.drop_irrelevant, settings)
            .transform(C.flatten_nested, settings))


def typed(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return flattened(raw, settings).transform(C.convert_types)


def nullified(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return typed(raw, settings).transform(C.nullify, settings)


def deduped(raw: DataFrame, settings: Settings = DEFAULTS, prefer=None) -> DataFrame:
    return nullified(raw, settings).transform(C.dedupe_by_id, prefer)


def released(raw: DataFrame, settings: Settings = DEFAULTS, prefer=None) -> DataFrame:
    return (deduped(raw, settings, prefer)
            .transform(C.require_id_title)
            .transform(C.released_only, settings))


CHECKPOINT_SITES = ("dropped", "flattened", "typed", "nullified", "deduped")


def clean_titles(raw: DataFrame, settings: Settings = DEFAULTS, prefer=None,
                 checkpoints=(), unique_ids: bool = False) -> DataFrame:
    """Raw documents -> the 22-column clean title table.  ``unique_ids``: every
    id occurs once (first copies are taken already), so nothing is shuffled.

    Lazy unless ``checkpoints`` names stage boundaries (any of
    ``CHECKPOINT_SITES``) at which to take a reliable checkpoint in the
    shared folder; a failed checkpoint only warns.  Off by default: a
    checkpoint is a full write and stops Catalyst optimising across it, so
    the one worth having, if any, is ``"deduped"`` (after the only shuffle).
    """
    unknown = set(checkpoints) - set(CHECKPOINT_SITES)
    if unknown:
        raise ValueError(f"unknown checkpoint sites {sorted(unknown)}")

    def cut(df, site):
        return checkpoint(df, site, log=log) if site in checkpoints else df

    df = cut(raw.transform(C.hoist_credits).transform(C.drop_irrelevant, settings), "dropped")
    df = cut(df.transform(C.flatten_nested, settings), "flattened")
    df = cut(df.transform(C.convert_types), "typed")
    df = cut(df.transform(C.nullify, settings), "nullified")
    if not unique_ids:
        df = cut(df.transform(C.dedupe_by_id, prefer), "deduped")
    return (df.transform(C.require_id_title)
            .transform(C.released_only, settings)
            .transform(C.min_non_null, settings)
            .transform(C.reorder, settings))
