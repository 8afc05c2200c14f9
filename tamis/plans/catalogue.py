"""Imports every query module, so the registry is complete."""

from importlib import import_module

MODULES = [
    "cleaning_queries", "quality_queries", "dedup_queries", "report_queries", "sampling_queries",
    "benchmark_queries", "label_queries", "run_queries", "wiki_queries", "router_queries", "source_queries",
]


def load() -> None:
    for name in MODULES:
        import_module(f"tamis.plans.{name}")
