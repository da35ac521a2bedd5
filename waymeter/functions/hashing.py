"""Row identity that does not depend on partitioning, row order or retries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymeter.functions.columns import quoted

BUCKETS = 10_000


def content_hash(columns: Sequence[str]) -> Column:
    """MD5 of the columns' text, in the order given."""
    return F.md5(F.concat_ws("|", *[quoted(c).cast("string") for c in columns]))


def hash_bucket(digest: Column) -> Column:
    """0..9999 from the first 32 bits of a hex digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS
