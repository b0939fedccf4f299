"""The dependency graph of the models: selection, and running what is ready.

A graph maps a node to the nodes it reads. Selection follows the usual notation: a name,
``+name`` (with everything it reads, directly or not), ``name+`` (with everything that
reads it), ``+name+``, or a layer's name for all its models; several selections are
united, and ``exclude`` takes away. ``run`` starts a node as soon as everything it reads
has ended, at most ``threads`` at once. A node that fails keeps back those that read it,
directly or not; the others still run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from queue import SimpleQueue

THREADS = 4


def order(inputs: Mapping[str, Iterable[str]]) -> list[str]:
    """The nodes, each after what it reads. A cycle is a ``graphlib.CycleError``."""
    return [n for n in TopologicalSorter({k: list(v) for k, v in inputs.items()}).static_order() if n in inputs]


def _reach(inputs: Mapping[str, Iterable[str]], start: str) -> set[str]:
    found, todo = set(), [start]
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += [n for n in inputs.get(name, ()) if n in inputs]
    return found


def readers(inputs: Mapping[str, Iterable[str]]) -> dict[str, list[str]]:
    """The graph the other way round: a node with the nodes that read it."""
    out: dict[str, list[str]] = {name: [] for name in inputs}
    for name, below in inputs.items():
        for b in below:
            if b in out:
                out[b].append(name)
    return out


def _chosen(inputs: Mapping[str, Iterable[str]], layers: Mapping[str, str], terms: Iterable[str]) -> set[str]:
    above = readers(inputs)
    out: set[str] = set()
    for term in terms:
        name = term.strip().removeprefix("+").removesuffix("+")
        names = [n for n in inputs if n == name or layers.get(n) == name]
        if not names:
            raise KeyError(f"no model or layer is named {name!r}")
        for n in names:
            out.add(n)
            out |= _reach(inputs, n) if term.strip().startswith("+") else set()
            out |= _reach(above, n) if term.strip().endswith("+") else set()
    return out


def select(inputs: Mapping[str, Iterable[str]], layers: Mapping[str, str], terms: Iterable[str] | None = None,
           exclude: Iterable[str] = ()) -> list[str]:
    """The selected nodes in an order that respects the graph (all of them if ``terms`` is None)."""
    chosen = set(inputs) if terms is None else _chosen(inputs, layers, terms)
    chosen -= _chosen(inputs, layers, exclude)
    return [n for n in order(inputs) if n in chosen]


@dataclass
class Outcome:
    """What became of each node: its result, its error, or that it was skipped."""
    done: dict[str, object] = field(default_factory=dict)
    failed: dict[str, BaseException] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    def check(self) -> None:
        """Raise the first failure, with the names of all failed and skipped nodes."""
        if self.failed:
            first = next(iter(self.failed))
            raise RuntimeError(f"failed: {list(self.failed)}, skipped: {self.skipped}; {first}: {self.failed[first]}") from self.failed[first]


def run(inputs: Mapping[str, Iterable[str]], names: Iterable[str], prepare: Callable[[str], Callable[[], object]],
        threads: int = THREADS, ended: Callable[[str, object], None] = lambda name, result: None) -> Outcome:
    """Run ``names``. ``prepare`` gives a node's job; it and ``ended`` are called on this thread, jobs run on others.

    What a node reads outside ``names`` is taken to be there already.
    """
    names = list(names)
    sorter = TopologicalSorter({n: [b for b in inputs[n] if b in names] for n in names})
    sorter.prepare()
    outcome = Outcome()
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        running, over = {}, SimpleQueue()   # over: the jobs in the order in which they end
        while True:
            for name in sorter.get_ready():
                try:
                    future = pool.submit(prepare(name))
                    running[future] = name
                    future.add_done_callback(over.put)
                except Exception as error:   # its plan can't be made
                    outcome.failed[name] = error
            if not running:
                break
            future = over.get()
            name = running.pop(future)
            if future.exception() is not None:
                outcome.failed[name] = future.exception()
                continue
            outcome.done[name] = future.result()
            ended(name, future.result())
            sorter.done(name)
    outcome.skipped = [n for n in names if n not in outcome.done and n not in outcome.failed]
    return outcome
