"""User-supplied row rules."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame


class RuleRegistry:
    """Named functions from columns to a column.

    Rules written with built-in functions stay inside generated code. A pandas
    UDF is accepted as well, but it moves every row to Python and back, so
    registering one warns.
    """

    def __init__(self) -> None:
        self._rules: dict[str, Callable[..., Column]] = {}

    def add(self, name: str, rule: Callable[..., Column]) -> Callable[..., Column]:
        if hasattr(rule, "evalType"):
            warnings.warn(f"rule {name} runs in Python", stacklevel=2)
        self._rules[name] = rule
        return rule

    def rule(self, name: str) -> Callable[[Callable[..., Column]], Callable[..., Column]]:
        """Decorator form of `add`."""
        return lambda fn: self.add(name, fn)

    def apply(self, df: DataFrame, outputs: Mapping[str, tuple[str, tuple[Column, ...]]]) -> DataFrame:
        """Add columns `{out: (rule name, arguments)}`."""
        return df.withColumns({out: self._rules[name](*args) for out, (name, args) in outputs.items()})


def apply_rules(df: DataFrame, registry: RuleRegistry, outputs: Mapping[str, tuple[str, tuple[Column, ...]]]) -> DataFrame:
    return registry.apply(df, outputs)
