"""Settings that depend on the size of the input. The caller applies them; nothing here does."""

from __future__ import annotations

# What one task should read or shuffle.
TASK_BYTES = 128 * 1024 * 1024

# Raw rows are shuffled whole for de-duplication, and text grows when it leaves Parquet.
SHUFFLE_GROWTH = 3


def settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """SQL settings for a batch run over ``input_bytes`` of Parquet on ``total_cores``.

    Adaptive execution merges partitions that turn out small and splits skewed ones, but it
    never raises their number, so the start is sized from the input.
    """
    shuffled = -(-input_bytes * SHUFFLE_GROWTH // TASK_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(max(total_cores, shuffled)),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
