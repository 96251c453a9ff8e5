"""A listing of many objects as a Spark data source: one partition per prefix, and a stream that goes on behind the last keys.

    spark.dataSource.register(ObjectListing)
    spark.read.format("object_listing").option("root", "s3://bucket/raw").option("bucket", "raw").load()
    spark.readStream.format("object_listing")...

The driver lists the prefixes alone (by default the folders directly below the root); tasks list what is below them, folder by folder,
so no more than one folder's entries are held at a time. Contents are not read. Stores are those that Arrow's file systems reach.

The stream's offset is the last key of each prefix, in the order of the keys' characters. Finding it takes a few listings per prefix,
since only the last folder on every level is looked into. An object whose key comes before the last one seen of its prefix is
not seen any more, so keys must grow with time, as in dated folders.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from mediacat.schemas import OBJECT_LISTING

ROWS = 10_000
LAST = "\U0010ffff"


class Prefix(InputPartition):
    """The keys of one prefix behind `start`, up to `end`."""

    def __init__(self, name: str, start: str = "", end: str = LAST) -> None:
        super().__init__((name, start, end))
        self.name, self.start, self.end = name, start, end


class Store:
    """Listings below a root, by keys relative to it."""

    def __init__(self, options: dict[str, str]) -> None:
        root = options["root"]
        self.files, path = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        self.path = path.rstrip("/")
        self.bucket = options.get("bucket", "")
        self.named = json.loads(options["prefixes"]) if "prefixes" in options else None

    def entries(self, folder: str) -> list[tuple[str, fs.FileInfo]]:
        """(key, entry) in the order of keys; the key of a folder ends with a slash. What is hidden (names with a leading _ or .) is left out."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/{folder}".rstrip("/"), allow_not_found=True))
        shown = (e for e in found if e.base_name[:1] not in ("_", "."))
        return sorted((f"{folder}{e.base_name}{'/' if e.type == fs.FileType.Directory else ''}", e) for e in shown)

    def prefixes(self) -> list[str]:
        """Given ones, or the folders below the root, and "" for files that lie in the root itself."""
        if self.named is not None:
            return [p.rstrip("/") + "/" for p in self.named]
        return ["", *(key for key, _ in self.entries("") if key.endswith("/"))]

    def keys(self, prefix: str, start: str, end: str) -> Iterator[tuple[str, fs.FileInfo]]:
        stack = [iter(self.entries(prefix))]
        while stack:
            for key, entry in stack[-1]:
                if key.endswith("/"):
                    behind = key + LAST > start and key <= end
                    if behind and prefix:  # the folders below the root are prefixes of their own
                        stack.append(iter(self.entries(key)))
                        break
                elif start < key <= end:
                    yield key, entry
            else:
                stack.pop()

    def last_key(self, folder: str, deeper: bool = True) -> str:
        """The greatest key below a folder, "" if there is none."""
        for key, _ in reversed(self.entries(folder)):
            found = (self.last_key(key) if deeper else "") if key.endswith("/") else key
            if found:
                return found
        return ""

    def rows(self, prefix: Prefix) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(OBJECT_LISTING)
        held: list[dict] = []
        for key, entry in self.keys(prefix.name, prefix.start, prefix.end):
            held.append({"bucket": self.bucket, "s3_key": key, "size_bytes": entry.size, "last_modified": entry.mtime.astimezone(timezone.utc), "etag": None})
            if len(held) == ROWS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Prefix]:
        return [Prefix(name) for name in Store(self.options).prefixes()]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return Store(self.options).rows(partition)


class ListingStream(DataSourceStreamReader):
    """Offsets map each prefix to its last key."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's names
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        store = Store(self.options)
        return {name: key for name in store.prefixes() if (key := store.last_key(name, deeper=bool(name)))}

    def partitions(self, start: dict, end: dict) -> list[Prefix]:
        return [Prefix(name, start.get(name, ""), last) for name, last in end.items() if last > start.get(name, "")]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return Store(self.options).rows(partition)

    def commit(self, end: dict) -> None:
        pass


class ObjectListing(DataSource):
    """Options: root (URI or path), bucket (name for the column), prefixes (a JSON list of folders below the root)."""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> object:
        return OBJECT_LISTING

    def reader(self, schema: object) -> DataSourceReader:
        return ListingReader(dict(self.options))

    def streamReader(self, schema: object) -> DataSourceStreamReader:  # noqa: N802
        return ListingStream(dict(self.options))
