"""Landings as immutable versions, and the pointer files that say which one counts.

``<path>/_pointers/<n>`` holds the name of a version's folder; the largest
readable number counts.  A pointer is a new small file each time: neither a rename
nor a replacement, which object stores don't do as one step.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from weir import folders

_END = "\n."


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_pointers"


def pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of all finished pointers, in order; a torn one is none."""
    found = []
    for name in folders.names(spark, _folder(path)):
        text = folders.read_small(spark, f"{_folder(path)}/{name}")
        if name.isdigit() and text.endswith(_END):
            found.append((int(name), text.removesuffix(_END)))
    return sorted(found)


def point(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the one that counts."""
    taken = [int(n) for n in folders.names(spark, _folder(path)) if n.isdigit()]
    folders.write_small(spark, f"{_folder(path)}/{max(taken, default=0) + 1:012d}", version + _END)


def forget(spark: SparkSession, path: str) -> None:
    """Remove what neither the current pointer nor the one before it names."""
    known = pointers(spark, path)
    kept = {v for _, v in known[-2:]}
    for name in folders.names(spark, path):
        if name.startswith("landing-") and name not in kept:
            folders.remove(spark, f"{path}/{name}")
    for n, _ in known[:-2]:
        folders.remove(spark, f"{_folder(path)}/{n:012d}")


def current(spark: SparkSession, path: str) -> str:
    """The folder of the version that counts; ``path`` itself where nothing was landed this way."""
    known = pointers(spark, path)
    return f"{path.rstrip('/')}/{known[-1][1]}" if known else path
