"""Message files as a stream whose batches are bounded in messages, not in files.

Files that arrive are numbered in a manifest, in the order they are found. A position in the feed
is a file's number and a byte in it, so it stays small however many files there are, and any line
end can end a batch. To find where a batch ends, the driver counts the line ends of that batch
and no others; the messages themselves are read by tasks, in ranges of bytes.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes counted at a time on the driver, and read by one task.
_COUNTED, _READ = 1 << 20, 16 << 20
_COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")
_LINE = pa.schema([("value", pa.string())])


def stream_messages(spark: SparkSession, path: str, manifest: str, max_messages: int) -> DataFrame:
    """Lines (``value``) of the files that arrive in a folder, at most ``max_messages`` a batch.

    ``manifest`` is a folder of the stream's own; keep it as long as the checkpoint. With the
    trigger ``availableNow`` a run takes one batch and stops; ``feed.drain`` takes all there are.

    Messages end at a line feed, a carriage return before it is dropped; the last one of a file
    needs none. Empty lines are messages. Bytes that are not UTF-8 become replacement characters.
    Files must not change once they are there; names that begin with ``.`` or ``_`` and empty
    files are passed over, compressed files refused. Both folders may lie on any file system
    that pyarrow knows by the path's scheme.
    """
    if max_messages < 1:
        raise ValueError("max_messages must be at least 1")
    spark.dataSource.register(MessageFiles)
    options = {"feed": path, "manifest": manifest, "max_messages": str(max_messages)}
    return spark.readStream.format(MessageFiles.name()).options(**options).load()


class MessageFiles(DataSource):
    """The stream's registration with Spark."""

    @classmethod
    def name(cls) -> str:
        return "message_files"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> "MessageReader":
        return MessageReader(self.options["feed"], self.options["manifest"], int(self.options["max_messages"]))


class Manifest:
    """The files of a feed in the order they were found: one JSON list for each time some were."""

    def __init__(self, feed: str, folder: str):
        self._system, self._feed = fs.FileSystem.from_uri(feed) if "://" in feed else (fs.LocalFileSystem(), feed)
        self._own, self._folder = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        self.files: list[tuple[str, int]] = []
        self._parts = 0
        found = self._own.get_file_info(fs.FileSelector(self._folder, allow_not_found=True))
        for info in sorted(found, key=lambda info: info.base_name):
            if info.base_name.isdigit():
                with self._own.open_input_stream(info.path) as file:
                    self.files += [(name, size) for name, size in json.loads(file.read())]
                self._parts += 1
        self._known = {name for name, _ in self.files}

    def discover(self) -> bool:
        """Number the files that are new; whether there are any. They are stored before they count."""
        infos = self._system.get_file_info(fs.FileSelector(self._feed, allow_not_found=True))
        new = [
            info
            for info in infos
            if info.type == fs.FileType.File
            and info.size
            and not info.base_name.startswith((".", "_"))
            and info.path not in self._known
        ]
        if not new:
            return False
        for info in new:
            if info.base_name.endswith(_COMPRESSED):
                raise ValueError(f"a compressed file cannot be read from its middle: {info.path}")
        new.sort(key=lambda info: (info.mtime_ns, info.path))
        rows = [(info.path, info.size) for info in new]
        self._own.create_dir(self._folder, recursive=True)
        unfinished = f"{self._folder}/.unfinished"
        with self._own.open_output_stream(unfinished) as file:
            file.write(json.dumps(rows).encode())
        self._own.move(unfinished, f"{self._folder}/{self._parts:012d}")
        self._parts += 1
        self.files += rows
        self._known.update(name for name, _ in rows)
        return True

    def open(self, number: int):
        return self._system.open_input_file(self.files[number][0])


class MessageReader(DataSourceStreamReader):
    """Positions are {"file": number of the file, "byte": where its next message begins}."""

    def __init__(self, feed: str, manifest: str, max_messages: int):
        self._paths, self._most = (feed, manifest), max_messages
        self._listed: Manifest | None = None
        self._reached = self.initialOffset()

    def __getstate__(self) -> dict:
        # Tasks are told their files; the list stays behind.
        return {**self.__dict__, "_listed": None}

    @property
    def _manifest(self) -> Manifest:
        if self._listed is None:
            self._listed = Manifest(*self._paths)
        return self._listed

    def initialOffset(self) -> dict:
        return {"file": 0, "byte": 0}

    def latestOffset(self) -> dict:
        """At most ``max_messages`` beyond the batches planned so far."""
        number, byte, left = self._reached["file"], self._reached["byte"], self._most
        while left and (number < len(self._manifest.files) or self._manifest.discover()):
            byte, met = self._after_lines(number, byte, left)
            left -= met
            if byte == self._manifest.files[number][1]:
                number, byte = number + 1, 0
        return {"file": number, "byte": byte}

    def _after_lines(self, number: int, byte: int, most: int) -> tuple[int, int]:
        """Where up to ``most`` lines from ``byte`` on end, and how many they are."""
        size, met = self._manifest.files[number][1], 0
        with self._manifest.open(number) as file:
            file.seek(byte)
            while byte < size:
                block = np.frombuffer(file.read(min(_COUNTED, size - byte)), np.uint8)
                if not len(block):
                    raise OSError(f"a file of the feed became shorter: {self._manifest.files[number][0]}")
                ends = np.flatnonzero(block == 0x0A)
                if met + len(ends) >= most:
                    return byte + int(ends[most - met - 1]) + 1, most
                met, byte, open_line = met + len(ends), byte + len(block), block[-1] != 0x0A
        return byte, met + int(open_line)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Ranges of bytes; Spark also calls this with the last known position when a stream goes on."""
        self._reached = end
        ranges = []
        for number in range(start["file"], end["file"] + (end["byte"] > 0)):
            name, size = self._manifest.files[number]
            first = start["byte"] if number == start["file"] else 0
            last = end["byte"] if number == end["file"] else size
            for begin in range(first, last, _READ):
                ranges.append(InputPartition((name, first, begin, min(begin + _READ, last), last)))
        return ranges

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """The lines that begin in the range; all end at or before ``last``."""
        name, first, begin, end, last = partition.value
        feed = self._paths[0]
        system = fs.FileSystem.from_uri(feed)[0] if "://" in feed else fs.LocalFileSystem()
        with system.open_input_file(name) as file:
            # A line that began before the range belongs to another task.
            before = int(begin > first)
            file.seek(begin - before)
            block = file.read(end - begin + before)
            if before:
                through = block.find(b"\n") + 1
                if not through or through > end - begin:
                    return
                block = block[through:]
            while end < last and not block.endswith(b"\n"):
                more = file.read(min(_COUNTED, last - end))
                line_end = more.find(b"\n") + 1
                block += more[:line_end] if line_end else more
                end += len(more)
                if line_end:
                    break
        lines = block.decode("utf-8", "replace").split("\n")
        if lines[-1] == "":
            lines.pop()
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array([line.removesuffix("\r") for line in lines], pa.string())], schema=_LINE)
