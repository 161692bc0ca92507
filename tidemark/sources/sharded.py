"""A streaming source of wire records in shards, with an offset for each shard.

A shard is a folder of Parquet files to which one writer at a time adds files; its offset is
the number of its files that were read, in the order of their modification times. A file
that comes to light after a younger one was read would be taken for that one, so two jobs
must not append to one shard at once. So a job starts at
the end of every shard (LATEST) or at its beginning (TRIM_HORIZON), a shard that appears
later is read from its beginning, and each shard is a partition of its own. The storage is
whatever pyarrow opens under the path.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.sources.wire import PARTITION_KEY, PAYLOAD, WIRE_SCHEMA

FORMAT = "sharded_log"
COLUMNS = pa.schema([(PARTITION_KEY, pa.string()), (PAYLOAD, pa.binary())])


class ShardFiles(InputPartition):
    """Files of one shard, in order."""

    def __init__(self, paths: tuple[str, ...]):
        super().__init__(paths)
        self.paths = paths


class ShardReader(DataSourceStreamReader):
    """Offsets are {shard: files read}; the files of a batch are those between two offsets."""

    def __init__(self, path: str, start: str):
        self.path = path
        self.start = start

    def _opened(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")

    def _files(self) -> dict[str, list[str]]:
        """The files of each shard as they came; names that tasks have not committed are hidden."""
        storage, root = self._opened()
        found = storage.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        shards: dict[str, list[tuple[int, str]]] = {}
        for info in found:
            inner = info.path[len(root) :].strip("/")
            if info.type != fs.FileType.File or re.search(r"(^|/)[._]", inner):
                continue
            shard = inner.rpartition("/")[0]
            shards.setdefault(shard, []).append((info.mtime_ns, info.path))
        return {shard: [path for _, path in sorted(files)] for shard, files in shards.items()}

    def _ends(self) -> dict[str, int]:
        return {shard: len(files) for shard, files in self._files().items()}

    def initialOffset(self) -> dict[str, int]:
        return self._ends() if self.start == "LATEST" else {}

    def latestOffset(self) -> dict[str, int]:
        return self._ends()

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[ShardFiles]:
        files = self._files()
        return [
            ShardFiles(tuple(files[shard][start.get(shard, 0) : last]))
            for shard, last in sorted(end.items())
            if last > start.get(shard, 0)
        ]

    def read(self, partition: ShardFiles) -> Iterator[pa.RecordBatch]:
        storage, _ = self._opened()
        for path in partition.paths:
            with storage.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(columns=COLUMNS.names):
                    yield batch.cast(COLUMNS)


class ShardedLog(DataSource):
    """``spark.readStream.format("sharded_log")`` with ``path`` and ``startingPosition``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return WIRE_SCHEMA

    def streamReader(self, schema: StructType) -> ShardReader:
        return ShardReader(self.options["path"], self.options.get("startingPosition", "LATEST"))
