"""Outcome and territory configuration as small driver-built dimensions."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import ComparatorSet, Outcome, Territory, outcome_definitions
from ..session import dimension


def outcome_dimension(spark: SparkSession, source: str | None = None, definitions: list[Outcome] | None = None) -> DataFrame:
    """One row per outcome and code range; ``source`` keeps what that source can classify."""
    chosen = definitions if definitions is not None else outcome_definitions(source)
    rows = [(o.section, o.id, o.label, r) for o in chosen for r in o.ranges]
    return dimension(spark, rows, "section string, outcome_id string, outcome_label string, code_range string")


def load_outcomes(path: str | Path) -> list[Outcome]:
    """Outcome definitions from a YAML file of sections, for deployments that keep their own."""
    sections = _load_yaml(path)
    return [
        Outcome(section, item["id"], item["label"], tuple(item.get("code_ranges") or ()), tuple(item.get("source") or ()))
        for section, items in sections.items() if isinstance(items, list)
        for item in items
    ]


def load_territory(path: str | Path, city: str) -> Territory:
    content = _load_yaml(path)
    return Territory(
        str(content["state"]["uf_ibge_code"]),
        str(content[city]["datasus_code_6_expected"]),
        str(content[city]["ibge_code_7"]),
    )


def load_comparators(path: str | Path) -> list[ComparatorSet]:
    """Comparator sets from a YAML file: the primary one, then the secondary ones in order.

    Each has an ``id`` and ``prefixes`` or ``municipalities``; ``include_selected`` keeps the compared
    area in. Sets that name no area yet are left out.
    """
    content = _load_yaml(path)["comparators"]
    items = [content["primary"], *(content.get("secondary") or [])]
    sets = [
        ComparatorSet(
            item["id"], tuple(str(p) for p in item.get("prefixes") or ()), tuple(str(c) for c in item.get("municipalities") or ()),
            bool(item.get("include_selected", False)),
        )
        for item in items
    ]
    return [s for s in sets if s.prefixes or s.codes]


def _load_yaml(path: str | Path) -> dict:
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML configuration needs PyYAML") from missing
    content = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(content, dict):
        raise ValueError(f"configuration must be a mapping: {path}")
    return content
