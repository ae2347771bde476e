"""Changes to a folder of partitions that survive a crash.

New files are written beside the table, in a folder of the swap. A marker that lists what is
to be done then makes the swap certain: it can be done over from any point, and whoever next
reads or writes the table finishes a swap whose marker it finds. A swap without a marker has
changed nothing.
"""

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from tidemark.files import Files

#: Folders or files that are moved at the same time.
_MOVERS = 16

_SWAP = "_swap-"
_READY = "READY"
_CHANGES = "_changes"


class Swaps:
    """The swaps of one table; one job at a time may write it."""

    def __init__(self, spark: SparkSession, path: str):
        self._files = Files(spark, path)
        self.path = path

    def start(self) -> str:
        """The name of a new folder to write into; what stopped writers left is settled."""
        self.finish()
        for name in self._files.names():
            if name.startswith(_SWAP):  # of a writer that failed before its marker
                self._files.delete(name)
        return f"{_SWAP}{uuid.uuid4().hex}"

    def put_partitions(self, swap: str, gone: Iterable[str] = (), written: "Written | None" = None) -> None:
        """The partitions written into ``swap`` take the place of those of their names, and
        those named in ``gone`` are removed."""
        made = self._made(swap)
        self._commit(swap, {"made": made, "gone": sorted({*gone} - {*made}), "written": _plain(written)})

    def put_files(self, swap: str, removed: Sequence[str], written: "Written | None" = None) -> None:
        """The files written into ``swap`` join their partitions, and ``removed`` ones go."""
        with ThreadPoolExecutor(_MOVERS) as movers:
            made = self._made(swap)
            inside = movers.map(lambda part: self._files.names(f"{swap}/{part}"), made)
            added = [f"{part}/{name}" for part, names in zip(made, inside) for name in names]
        fresh = sorted({*made} - {*self._files.names()})
        self._commit(swap, {"added": added, "fresh": fresh, "removed": sorted(removed), "written": _plain(written)})

    def finish(self) -> None:
        """Finish what a writer that has stopped left behind; else nothing."""
        files = self._files
        for swap in files.names():
            text = files.read(f"{swap}/{_READY}") if swap.startswith(_SWAP) else None
            if text is None:
                continue
            plan = json.loads(text)
            left = {*files.names(swap)}  # what has been moved before is not there any more

            def put(name: str) -> None:
                files.delete(name)
                if name in left:
                    files.move(f"{swap}/{name}", name)

            def add(name: str) -> None:
                if files.exists(f"{swap}/{name}"):
                    files.make(name.rsplit("/", 1)[0])
                    files.move(f"{swap}/{name}", name)

            with ThreadPoolExecutor(_MOVERS) as movers:
                list(movers.map(put, [*(n for n in plan.get("made", ()) if n in left), *plan.get("gone", ())]))
                list(movers.map(add, plan.get("added", ())))
                list(movers.map(files.delete, plan.get("removed", ())))
            self._note(plan)
            files.delete(swap)

    def changes(self) -> "Changes":
        """What is known of the rows that the partitions hold."""
        text = self._files.read(_CHANGES)
        return Changes([], {}) if text is None else Changes(**json.loads(text))

    def _made(self, swap: str) -> list[str]:
        return [n for n in self._files.names(swap) if "=" in n]

    def _commit(self, swap: str, plan: dict) -> None:
        self._files.write(f"{swap}/{_READY}", json.dumps(plan))
        self.finish()

    def _note(self, plan: dict) -> None:
        """Partitions with rows of which nothing is known stay unknown; else a bound is never
        lowered, and a declaration not forgotten, by files that join those that stay."""
        if plan.get("written") is None:
            return
        new, known = Written(**plan["written"]), self.changes()
        if new.declared not in known.declarations:
            known.declarations.append(new.declared)
        number = known.declarations.index(new.declared)
        for part in plan.get("gone", ()):
            known.parts.pop(part, None)
        for part in (*plan.get("made", ()), *plan.get("fresh", ())):
            known.parts[part] = {"bounds": dict(new.bounds), "declared": [number]}
        for part in {name.rsplit("/", 1)[0] for name in plan.get("added", ())} & {*known.parts}:
            old = known.parts[part]
            both = {*old["bounds"]} & {*new.bounds}
            bounds = {c: max((v for v in (old["bounds"][c], new.bounds[c]) if v is not None), default=None) for c in both}
            known.parts[part] = {"bounds": bounds, "declared": sorted({*old["declared"], number})}
        self._files.write(_CHANGES, json.dumps(asdict(known)))


@dataclass(frozen=True)
class Written:
    """What one write is known by: its declaration, as JSON, and the greatest value of each
    stamp among its rows, in microseconds."""

    declared: str
    bounds: Mapping[str, int | None]


@dataclass
class Changes:
    """By partition the ``bounds`` of its stamps, and which of the ``declarations`` its files
    were written under, as far as that is known."""

    declarations: list[str]
    parts: dict[str, dict]

    def bound(self, part: str, column: str, unknown: int) -> int | None:
        return self.parts.get(part, {"bounds": {}})["bounds"].get(column, unknown)

    def in_use(self) -> list[str]:
        """Declarations that files were written under."""
        numbers = {n for part in self.parts.values() for n in part["declared"]}
        return [self.declarations[n] for n in sorted(numbers)]


def _plain(written: Written | None) -> dict | None:
    return None if written is None else asdict(written)
