"""Inputs: declared-schema JSON documents, Parquet tables, and the
title-shaped fixture derived from the star-schema test tables."""

from marquee.sources.readers import (  # noqa: F401
    read_documents, read_table, read_clean, star_table,
)
from marquee.sources.fixtures import raw_titles, payloads, request_ids  # noqa: F401
