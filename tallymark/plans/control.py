"""What every control offers: lazy results, and publishing them."""

from __future__ import annotations

import abc
import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallymark import fixed_values as fv
from tallymark.runs.publish import publish_run
from tallymark.sinks.stores import Store


@dataclass(frozen=True)
class Target:
    """Where one result goes and how its runs are logged."""

    table: str
    control_type: int
    attribute_keys: tuple[int, ...] | None = None


def target(name: str, table: str | None = None, attribute_keys=None) -> Target:
    """Target of a result under its fixed control type."""
    return Target(table or name, fv.CONTROL_TYPES[name], attribute_keys)


class Control(abc.ABC):
    """A control computes named results and can publish them."""

    targets: Mapping[str, Target]

    @abc.abstractmethod
    def compute(self) -> dict[str, DataFrame]:
        """Results by name; at most inputs they share are written before."""

    def publish(self, store: Store, run_ts: dt.datetime | None = None) -> dict[str, int]:
        """Write every result and return the run keys by name."""
        keys = {}
        for name, result in self.compute().items():
            goal = self.targets[name]
            keys[name] = publish_run(
                store,
                result,
                goal.table,
                goal.control_type,
                attribute_keys=goal.attribute_keys,
                run_ts=run_ts,
            )
        return keys
