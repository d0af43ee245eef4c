"""Named intermediate values for long column expressions.

A URL rule needs the same piece many times over.  Written as one nested
expression it would be repeated at every use, so rules are given as a list of
``(name, build)`` steps, where ``build`` receives a lookup of earlier values.
Steps that need nothing of each other form one layer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Lookup = Callable[[str], Column]
Step = tuple[str, Callable[[Lookup], Column]]


@cache
def _needs(build: Callable[[Lookup], Column]) -> frozenset[str]:
    """Names a step reads.  Step lists are made once, so this is asked once."""
    seen: set[str] = set()
    blank = F.lit("")

    def note(name: str) -> Column:
        seen.add(name)
        return blank

    build(note)
    return frozenset(seen)


def _layers(inputs: Sequence[str], steps: Sequence[Step], outputs: Sequence[str]) -> list[tuple[list[str], list[Step]]]:
    """Layers of the steps ``outputs`` need, each with the older names still in use."""
    needs = {name: _needs(build) for name, build in steps}
    used, open_ = set(outputs), list(outputs)
    while open_:
        for n in needs.get(open_.pop(), ()):
            if n not in used:
                used.add(n)
                open_.append(n)
    depth = dict.fromkeys(inputs, 0)
    layers: list[list[Step]] = []
    for name, build in steps:
        if name in used:
            depth[name] = 1 + max((depth[n] for n in needs[name]), default=0)
            while len(layers) < depth[name]:
                layers.append([])
            layers[depth[name] - 1].append((name, build))
    placed = []
    for i, layer in enumerate(layers):
        later = set(outputs).union(*[needs[n] for rest in layers[i + 1:] for n, _ in rest])
        placed.append(([n for n, d in depth.items() if d <= i and n in later], layer))
    return placed


def as_column(inputs: Mapping[str, Column], steps: Sequence[Step]) -> Column:
    """The value of the last step as a single expression.

    A one-element array of structs is mapped through the layers.  Lambdas are
    interpreted: for bulk work :func:`with_steps` is several times faster.
    """
    last = steps[-1][0]
    state = F.array(F.struct(*[c.alias(n) for n, c in inputs.items()]))

    def extend(kept: Sequence[str], layer: Sequence[Step]) -> Callable[[Column], Column]:
        return lambda row: F.struct(
            *[row[n].alias(n) for n in kept], *[build(lambda n: row[n]).alias(name) for name, build in layer])

    for kept, layer in _layers(list(inputs), steps, [last]):
        state = F.transform(state, extend(kept, layer))
    return state[0][last]


def with_steps(df: DataFrame, inputs: Mapping[str, Column], steps: Sequence[Step],
               outputs: Mapping[str, str], required: str | None = None) -> DataFrame:
    """Add columns; ``outputs`` maps each new column to its step.

    Each layer is a projection, so everything runs in generated code and each
    value is computed once.  The results pass through a generator: Catalyst
    moves no filter below one that makes its column, which would unfold the
    layers again.  Rows whose text ``required`` is null or empty are left out.
    """
    def tmp(name: str) -> str:
        return f"__step_{name}"

    @cache
    def get(name: str) -> Column:
        return F.col(tmp(name))

    kept_cols = [F.col(f"`{c}`") for c in df.columns if c not in outputs]
    own = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*own, *[c.alias(tmp(n)) for n, c in inputs.items()])
    for kept, layer in _layers(list(inputs), steps, list(outputs.values())):
        df = df.select(*own, *[get(n) for n in kept], *[build(get).alias(tmp(name)) for name, build in layer])
    row = F.array(F.struct(*[get(src).alias(out) for out, src in outputs.items()]))
    if required is not None:
        row = F.when(F.length(get(outputs[required])) > 0, row)
    return df.select(*kept_cols, F.inline(row))
