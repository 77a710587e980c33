"""Models declared with their inputs: built in the order of their dependencies, each as its own kind.

A model is a function of the tables it names as inputs, which are sources or other models. ``run_models``
builds those that are wanted and what they need, each once: a ``view`` is inlined by the planner
wherever it is used, a ``table`` is written and read back, ``ephemeral`` leaves no name behind.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from chartmart.sources.files import materialize_as


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]  # of the inputs, in their order
    kind: str = "view"


def plan_models(models: Sequence[Model], sources: Sequence[str], wanted: Sequence[str] | None = None) -> list[str]:
    """Names of the models to build, inputs before what uses them. Unknown inputs and cycles are refused."""
    by_name = {m.name: m for m in models}
    if len(by_name) < len(models) or set(by_name) & set(sources):
        raise ValueError("model names must differ from each other and from the sources")
    needed, open_ = set(), list(by_name if wanted is None else wanted)
    while open_:
        name = open_.pop()
        if name in sources or name in needed:
            continue
        if name not in by_name:
            raise KeyError(f"no model or source is named {name!r}")
        needed.add(name)
        open_ += by_name[name].inputs
    graph = {n: {i for i in by_name[n].inputs if i in by_name} for n in sorted(needed)}
    return list(TopologicalSorter(graph).static_order())  # CycleError for a cycle


def run_models(models: Sequence[Model], sources: Mapping[str, DataFrame], wanted: Sequence[str] | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """The models by name; views and tables are stored as ``prefix`` and their name."""
    by_name, have = {m.name: m for m in models}, dict(sources)
    order = plan_models(models, list(sources), wanted)
    for name in order:
        model = by_name[name]
        have[name] = materialize_as(model.build(*[have[i] for i in model.inputs]), prefix + name, model.kind)
    return {name: have[name] for name in order}
