"""Keyword rules on free-text labels.

A keyword list becomes an OR of predicates, which Spark evaluates inside the scan stage; joining the list with LIKE
would force a nested-loop join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any(test: str, column: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{test}(lower({column}), {_text(w)})" for w in words) + ")" if words else "false"


def contains_any(column: str, patterns: Sequence[str], fold_patterns: bool = False) -> Column:
    """lower(column) contains any pattern. Patterns are literal: one with capitals never matches unless folded."""
    return F.expr(_any("contains", column, [p.lower() if fold_patterns else p for p in patterns]))


def starts_with_any(column: str, prefixes: Sequence[str]) -> Column:
    return F.expr(_any("startswith", column, prefixes))


def not_contains(column: str, pattern: str) -> Column:
    """NULL input stays NULL and is dropped by a filter."""
    return F.expr(f"NOT {_any('contains', column, [pattern])}")


@dataclass(frozen=True)
class LabelRule:
    """Items whose label starts with one of the prefixes are of this kind."""

    kind: str
    prefixes: tuple[str, ...]
    label_without: str | None = None
    category_without: str | None = None

    def matches(self, label: str, category: str | None) -> Column:
        test = starts_with_any(label, self.prefixes)
        if self.label_without:
            test = test & not_contains(label, self.label_without)
        if self.category_without:
            if category is None:
                raise ValueError(f"rule {self.kind} needs a category column")
            test = test & not_contains(category, self.category_without)
        return test


def label_kinds(items: DataFrame, rules: Sequence[LabelRule], item: str = "itemid", label: str = "label",
                category: str | None = None) -> DataFrame:
    """(item, kind) rows in one scan; an item that meets two rules appears twice."""
    kinds = F.array_compact(F.array(*[F.when(r.matches(label, category), F.lit(r.kind)) for r in rules]))
    return items.select(F.col(item), F.explode(kinds).alias("kind"))


def matching_items(items: DataFrame, patterns: Sequence[str], item: str = "itemid", label: str = "label",
                   prefix: bool = False, fold_patterns: bool = False) -> DataFrame:
    """Ids of the items whose label matches any pattern."""
    test = starts_with_any(label, patterns) if prefix else contains_any(label, patterns, fold_patterns)
    return items.filter(test).select(item)
