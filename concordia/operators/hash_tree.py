"""A tree of checksums: finer buckets inside those that differ, where counts say it pays."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BROADCAST_BUCKETS, CHECKSUM_BUCKETS, CHECKSUM_REFINEMENT, ROWS_PER_SHUFFLE_TASK
from ..functions.fingerprint import XXHASH64
from ..sources.scratch import checkpointed
from .checksum import bucket_checksum, bucket_compare, checksum_refined

#: Share of a level's buckets up to which looking inside the differing ones is worth a scan.
SPARSE = 0.5
_MOST_BUCKETS = 1 << 31
_NODE = ("bucket_id", "source_count", "sink_count", "source_hash", "sink_hash")


@dataclass(frozen=True)
class ChecksumTree:
    """Differing nodes of all levels, and those of the last level, the leaves.

    ``nodes`` has ``level`` and ``bucket_count`` (buckets of that level) beside both sides'
    counts and hashes.  ``touched`` rows of both sides lie in the leaves.
    """

    nodes: DataFrame
    leaves: DataFrame
    bucket_count: int
    differing: int
    touched: int
    levels: int


def _counts(differing: DataFrame) -> tuple[int, int]:
    """Number of nodes and the rows of both sides in them."""
    rows = F.coalesce("source_count", F.lit(0)) + F.coalesce("sink_count", F.lit(0))
    found = differing.agg(F.count(F.lit(1)).alias("n"), F.sum(rows).alias("rows")).first()
    return found["n"], found["rows"] or 0


def checksum_tree(
    source: DataFrame,
    sink: DataFrame,
    bucket_count: int = CHECKSUM_BUCKETS,
    fanout: int = CHECKSUM_REFINEMENT,
    bucket_fn: str = XXHASH64,
    leaf_rows: int = ROWS_PER_SHUFFLE_TASK,
    compared: DataFrame | None = None,
) -> ChecksumTree:
    """Descend from ``bucket_count`` buckets into the differing ones, ``fanout`` parts a level.

    A level costs one more scan of both frames of row hashes, and what it saves is rows
    that a row diff would shuffle.  So the descent ends when the differing buckets hold at
    most ``leaf_rows`` rows, when more than half of the buckets looked at differ (changes
    are everywhere, so finer buckets would differ as well), when ids would leave 32 bits
    or when there are too many to be broadcast.  ``compared`` is the ``bucket_compare``
    frame of the first level if it is at hand.
    """
    if fanout < 1:
        raise ValueError(f"fanout must be positive, got {fanout}")
    if compared is None:
        sides = (bucket_checksum(side, bucket_count, bucket_fn) for side in (source, sink))
        compared = checkpointed(bucket_compare(*sides))

    def nodes_of(differing: DataFrame, level: int, buckets: int) -> DataFrame:
        numbered = [F.lit(level).alias("level"), F.lit(buckets).cast("long").alias("bucket_count")]
        return differing.select(*numbered, *_NODE)

    leaves, level, looked_at = compared.filter("differs").drop("differs"), 0, bucket_count
    differing, touched = _counts(leaves)
    found = [nodes_of(leaves, 0, bucket_count)]
    while (
        fanout > 1
        and touched > leaf_rows
        and differing <= SPARSE * looked_at
        and differing <= BROADCAST_BUCKETS
        and bucket_count * fanout <= _MOST_BUCKETS
    ):
        leaves = checkpointed(checksum_refined(source, sink, leaves, bucket_count, fanout, bucket_fn))
        looked_at, bucket_count, level = differing * fanout, bucket_count * fanout, level + 1
        differing, touched = _counts(leaves)
        found.append(nodes_of(leaves, level, bucket_count))
    return ChecksumTree(reduce(DataFrame.union, found), leaves, bucket_count, differing, touched, level + 1)
