"""Names in the session catalog."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(frames: Mapping[str, DataFrame]) -> list[str]:
    """Create or replace one temporary view per frame, in the given order."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def unregister(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)


def tables_present(spark: SparkSession, expected: Iterable[str]) -> list[str]:
    """Those of the expected tables and views the catalog knows, sorted."""
    known = {t.name for t in spark.catalog.listTables()}
    return sorted(known.intersection(expected))


@dataclass
class ViewGraph:
    """Views of the session catalog with what they are made from, so that one can be
    replaced or dropped without leaving others on the old definition.

    A view is a function of the frames of its ``sources`` (base tables or views). The order
    of definition is free; cycles and unknown sources are errors. A change is planned
    whole before any name in the catalog changes, so one that does not resolve, as a dependant
    that misses a column, changes nothing.
    """

    tables: dict[str, DataFrame]
    views: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = field(default_factory=dict)

    def define(self, name: str, sources: Sequence[str], build: Callable[..., DataFrame]) -> None:
        if name in self.tables or name in self.views:
            raise ValueError(f"{name} is defined already")
        self.views[name] = (tuple(sources), build)

    def order(self, views: Mapping[str, tuple[tuple[str, ...], Callable]] | None = None) -> list[str]:
        """All views, each after its sources."""
        views = self.views if views is None else views
        out: list[str] = []
        open_: set[str] = set()

        def visit(name: str, user: str) -> None:
            if name in self.tables or name in out:
                return
            if name not in views:
                raise KeyError(f"{user} reads {name}, which is not defined")
            if name in open_:
                raise ValueError(f"{name} depends on itself")
            open_.add(name)
            for source in views[name][0]:
                visit(source, name)
            out.append(name)

        for name in views:
            visit(name, name)
        return out

    def dependants(self, name: str) -> list[str]:
        """Views that read ``name``, over any number of steps, in order."""
        reached = {name}
        out = []
        for view in self.order():
            if reached & set(self.views[view][0]):
                reached.add(view)
                out.append(view)
        return out

    def _built(self, names: Iterable[str], views: Mapping) -> dict[str, DataFrame]:
        frames = dict(self.tables)
        for name in self.order(views):
            sources, build = views[name]
            frames[name] = build(*(frames[s] for s in sources))
        return {n: frames[n] for n in names}

    def create(self) -> list[str]:
        """Register the tables and all views."""
        made = self._built(self.order(), self.views)
        return register(self.tables) + register(made)

    def replace(self, name: str, build: Callable[..., DataFrame], sources: Sequence[str] | None = None) -> list[str]:
        """Give a view another definition and make all that depends on it anew; the
        names changed, in order."""
        old, _ = self.views[name]
        views = {**self.views, name: (tuple(old if sources is None else sources), build)}
        self.order(views)
        names = [name, *self.dependants(name)]
        made = self._built(names, views)
        self.views = views
        return register(made)

    def reload(self, name: str, table: DataFrame) -> list[str]:
        """Give a base table other rows; views over it are made anew."""
        before, self.tables = self.tables, {**self.tables, name: table}
        try:
            made = self._built(self.dependants(name), self.views)
        except Exception:
            self.tables = before
            raise
        return register({name: table} | made)

    def drop(self, name: str, cascade: bool = False) -> list[str]:
        """Drop a view; with dependants only if ``cascade`` is set, which drops them first."""
        users = self.dependants(name)
        if users and not cascade:
            raise ValueError(f"{name} is read by {', '.join(users)}")
        gone = [*reversed(users), name]
        spark = next(iter(self.tables.values())).sparkSession
        unregister(spark, gone)
        self.views = {n: v for n, v in self.views.items() if n not in gone}
        return gone
