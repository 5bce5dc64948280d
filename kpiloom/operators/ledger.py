"""Numbers of loads: which came first, which are done.

A load takes the next number before it writes, and every row it writes carries that
number as a partition. Only when all its tables are written is the load done; readers
leave out the rows of loads that are not. So a load that fails changes nothing, and one
that is repeated under its name starts anew with the same number, or is known as done.
Numbers follow the order of the loads and no clock.

The marks are empty files in `<root>/_loads`: a number is claimed by creating
`claim-<number>`, which only one driver can, and a load is done once its mark is renamed.
Marks of earlier done loads of a name are removed, so there are about as many as names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from kpiloom.session import file_system, remove_folder

FOLDER = "_loads"


@dataclass(frozen=True)
class Load:
    number: int
    #: The whole load was done before, under its name and batch.
    done: bool = False


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}"


def _marks(spark: SparkSession, root: str) -> list[tuple[str, int, str]]:
    """(state, number, name) of the marks."""
    fs, path = file_system(spark, root)
    folder = path(_folder(root))
    if not fs.exists(folder):
        return []
    marks = []
    for status in fs.listStatus(folder):
        state, number, *name = str(status.getPath().getName()).split("-", 2)
        marks.append((state, int(number), name[0] if name else ""))
    return sorted(marks, key=lambda m: m[1])


def _mark(state: str, number: int, name: str = "") -> str:
    return "-".join(filter(None, [state, f"{number:012d}", name]))


def _name(source: str | None, batch: int | None, number: int) -> str:
    text = f"load {number}" if source is None else source
    return f"{hashlib.md5(text.encode()).hexdigest()}-{-1 if batch is None else batch}"


def unfinished(spark: SparkSession, root: str) -> list[int]:
    """Numbers of loads that began and are not done; their rows do not count."""
    return [number for state, number, _ in _marks(spark, root) if state == "open"]


def begin(spark: SparkSession, root: str, source: str | None = None, batch: int | None = None) -> Load:
    """Takes a number. `source` and `batch`, say a stream and its batch number, name a load that may come again."""
    fs, path = file_system(spark, root)
    folder = _folder(root)
    fs.mkdirs(path(folder))
    marks = _marks(spark, root)
    if source is not None:
        name = _name(source, batch, 0)
        for state, number, known in marks:
            if known == name and state == "done":
                return Load(number, done=True)
            if known == name and state == "open":
                discard(spark, root, number)
                return Load(number)
    number = max((n for _, n, _ in marks), default=0) + 1
    while not fs.createNewFile(path(f"{folder}/{_mark('claim', number)}")):
        number += 1
    fs.createNewFile(path(f"{folder}/{_mark('open', number, _name(source, batch, number))}"))
    return Load(number)


def commit(spark: SparkSession, root: str, load: Load) -> None:
    """The load is done: from now on its rows count."""
    fs, path = file_system(spark, root)
    folder = _folder(root)
    marks = _marks(spark, root)
    name = next(name for state, number, name in marks if state == "open" and number == load.number)
    if not fs.rename(path(f"{folder}/{_mark('open', load.number, name)}"), path(f"{folder}/{_mark('done', load.number, name)}")):
        raise OSError(f"cannot mark load {load.number} as done")
    latest = max(number for _, number, _ in marks)
    source = name.split("-")[0]
    # A name's last done load is remembered, and the highest number.
    for state, number, known in marks:
        mine = state == "done" and known.split("-")[0] == source and number < load.number
        nameless = state == "done" and known == _name(None, None, number) and number < latest
        claimed = state == "claim" and number < latest
        if mine or nameless or claimed:
            fs.delete(path(f"{folder}/{_mark(state, number, known)}"), False)


def discard(spark: SparkSession, root: str, number: int) -> None:
    """Removes what an unfinished load has written."""
    fs, path = file_system(spark, root)
    for status in fs.globStatus(path(f"{root.rstrip('/')}/*/*/*/*/load_number={number}")) or []:
        remove_folder(spark, str(status.getPath()))


@contextmanager
def loading(spark: SparkSession, root: str, source: str | None = None, batch: int | None = None) -> Iterator[Load]:
    """The load is done if the block ends without an error."""
    load = begin(spark, root, source, batch)
    yield load
    if not load.done:
        commit(spark, root, load)
