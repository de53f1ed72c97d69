"""Named sources: raw feeds, staging tables, seeds and catalogue tables by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from ..schemas import FEED_NAMES, raw_schema, staged_schema
from .files import GENRE_ALIASES, load_genres, read_seed
from .sinks import read_table

Reader = Callable[[SparkSession], DataFrame]


class Sources:
    """A registry of ``namespace.table`` names; ``load`` reads one of them.

    Nothing is read when a name is added, and a table is found anew at each load, so
    a rebuilt one is seen. A name without namespace is taken where only one
    namespace has it.
    """

    def __init__(self):
        self._readers: dict[str, Reader] = {}

    def add(self, name: str, reader: Reader) -> Sources:
        if "." not in name:
            raise ValueError(f"{name}: a source is named namespace.table")
        self._readers[name] = reader
        return self

    def add_table(self, name: str, path: str, schema: T.StructType | None = None) -> Sources:
        """A published table or a plain Parquet folder."""
        return self.add(name, lambda spark: read_table(spark, path, schema))

    def add_raw_feeds(self, root: str, feeds: Iterable[str] = FEED_NAMES, namespace: str = "raw") -> Sources:
        """The hour folders of each feed under ``root``, all of them."""
        for feed in feeds:
            self.add_table(f"{namespace}.{feed}", f"{root.rstrip('/')}/{feed}", raw_schema(feed))
        return self

    def add_staging(self, root: str, feeds: Iterable[str] = FEED_NAMES, namespace: str = "staging") -> Sources:
        """The staging tables that the hourly loads or the stream write under ``root``."""
        for feed in feeds:
            self.add_table(f"{namespace}.{feed}", f"{root.rstrip('/')}/{feed}", staged_schema(feed, with_hour=True, with_load=True))
        return self

    def add_seed(self, name: str, path: str) -> Sources:
        return self.add(name, lambda spark: read_seed(spark, path))

    def add_genres(self, registry: Mapping[str, str], namespace: str = "imdb") -> Sources:
        """One table per genre file, under its logical name and its alias, and
        ``movies``, the catalogue of all that exist."""
        for genre, path in registry.items():
            reader = lambda spark, genre=genre, path=path: load_genres(spark, {genre: path})
            for name in {genre, GENRE_ALIASES.get(genre, genre)}:
                self.add(f"{namespace}.{name}", reader)
        return self.add(f"{namespace}.movies", lambda spark: load_genres(spark, registry))

    def names(self) -> list[str]:
        return sorted(self._readers)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        found = [name] if name in self._readers else [n for n in self.names() if n.partition(".")[2] == name]
        if len(found) != 1:
            raise KeyError(f"{name}: {'one of ' + ', '.join(found) if found else 'no such source; there are ' + ', '.join(self.names())}")
        return self._readers[found[0]](spark)
