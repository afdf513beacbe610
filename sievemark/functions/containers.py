"""Container statistics: arithmetic over nested counters, maps and arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATS_SCHEMA = """
cpu_stats struct<cpu_usage: struct<total_usage: bigint, percpu_usage: array<bigint>>,
                 system_cpu_usage: bigint, online_cpus: int>,
precpu_stats struct<cpu_usage: struct<total_usage: bigint>, system_cpu_usage: bigint>,
memory_stats struct<usage: bigint, limit: bigint, stats: struct<inactive_file: bigint>>,
networks map<string, struct<rx_bytes: bigint, tx_bytes: bigint>>,
blkio_stats struct<io_service_bytes_recursive: array<struct<op: string, value: bigint>>>
"""

# Operation names that count as reads and as writes.
READ_OPS = ["read", "rbytes"]
WRITE_OPS = ["write", "wbytes"]


def _sum(values: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(values, zero, lambda s, x: s + F.coalesce(x, zero)), zero)


def map_sum(entries: Column, field: str) -> Column:
    """Sum of a struct field over all map entries; 0 for a missing map."""
    return _sum(F.transform(F.map_values(entries), lambda e: e[field]))


def op_sum(entries: Column, ops: list[str]) -> Column:
    """Sum of ``value`` where the lower-case ``op`` is in a set; 0 for a missing array."""
    return _sum(F.transform(F.filter(entries, lambda e: F.lower(e["op"]).isin(ops)), lambda e: e["value"]))


def cpu_percent(stats: Column) -> Column:
    """Δcpu / Δsystem × cores × 100 (2 decimals); 0 when a counter is missing or runs backwards."""
    zero = F.lit(0)
    cpu = stats["cpu_stats"]["cpu_usage"]["total_usage"] - stats["precpu_stats"]["cpu_usage"]["total_usage"]
    system = F.coalesce(stats["cpu_stats"]["system_cpu_usage"], zero) - F.coalesce(
        stats["precpu_stats"]["system_cpu_usage"], zero
    )
    per_cpu = F.greatest(F.coalesce(F.size(stats["cpu_stats"]["cpu_usage"]["percpu_usage"]), F.lit(1)), F.lit(1))
    cores = F.coalesce(F.nullif(stats["cpu_stats"]["online_cpus"], zero), per_cpu)
    return F.coalesce(
        F.when((system > 0) & (cpu >= 0), F.round(cpu / system * cores * 100.0, 2)), F.lit(0.0)
    )


def memory_used(stats: Column) -> Column:
    """Usage without the inactive page cache, never negative."""
    mem = stats["memory_stats"]
    zero = F.lit(0)
    return F.greatest(
        F.coalesce(mem["usage"], zero) - F.coalesce(mem["stats"]["inactive_file"], zero), zero
    ).cast("double")


def memory_limit(stats: Column) -> Column:
    return F.coalesce(stats["memory_stats"]["limit"], F.lit(0)).cast("double")


def memory_percent(stats: Column) -> Column:
    """Percent of the limit (2 decimals), 0 without a limit."""
    limit = memory_limit(stats)
    return F.when(limit > 0, F.round(memory_used(stats) / limit * 100.0, 2)).otherwise(F.lit(0.0))


def container_metrics(status: Column, stats: Column) -> list[Column]:
    """All gauges of a container; a stopped one reports zeros and ``up = 0``."""
    running = status == "running"

    def gauge(value: Column, name: str) -> Column:
        return F.when(running, value.cast("double")).otherwise(F.lit(0.0)).alias(name)

    block = stats["blkio_stats"]["io_service_bytes_recursive"]
    return [
        F.when(running, 1).otherwise(0).alias("up"),
        gauge(cpu_percent(stats), "cpu_percent"),
        gauge(memory_used(stats), "memory_usage"),
        gauge(memory_limit(stats), "memory_limit"),
        gauge(memory_percent(stats), "memory_percent"),
        gauge(map_sum(stats["networks"], "rx_bytes"), "network_rx"),
        gauge(map_sum(stats["networks"], "tx_bytes"), "network_tx"),
        gauge(op_sum(block, READ_OPS), "block_read"),
        gauge(op_sum(block, WRITE_OPS), "block_write"),
    ]
