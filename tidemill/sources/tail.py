"""A stream over growing text files that remembers byte offsets per file.

A file is known by its name and its first bytes. One that is shorter than what was read, or begins otherwise, has been
rotated or rewritten under its name and is read from its start. One that has vanished is left out, and is new if its
name comes back; lines of it that were planned but not yet read are gone. A last line without a line feed waits until
it is finished; a run with the option `finish` delivers it as it is, for files that will not grow any more.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_BLOCK = 1 << 16
#: First bytes that tell a file from another one of its name.
_HEAD = 256


class _TailReader(DataSourceStreamReader):
    """Offset: {file name: [bytes read, first bytes in hex]}, kept by Spark in the checkpoint.

    A batch covers whole lines only.  The new bytes of a file are cut into
    ranges of `split_bytes`; a range owns the lines that begin in it.
    """

    def __init__(self, options):
        self.where = options["path"]
        self.split = int(options.get("split_bytes", str(32 << 20)))
        self.suffix = options.get("suffix", "")
        self.finish = options.get("finish", "false").lower() == "true"
        self.ends = {}

    def _files(self):
        store, folder = fs.FileSystem.from_uri(self.where)
        found = store.get_file_info(fs.FileSelector(folder))
        return store, {
            # As with Spark's own readers, names that begin with a dot or an underscore are not data.
            f.base_name: f for f in found
            if f.type == fs.FileType.File and f.base_name.endswith(self.suffix) and f.base_name[:1] not in "._"
        }

    def initialOffset(self):
        return {}

    def latestOffset(self):
        store, files = self._files()
        out = {}
        for name, info in sorted(files.items()):
            state = (info.size, info.mtime_ns)
            # Only files that changed are opened.
            if self.ends.get(name, (None,))[0] != state:
                try:
                    end = info.size if self.finish else _end_of_last_line(store, info)
                    self.ends[name] = (state, [end, _head(store, info.path, end)])
                except FileNotFoundError:
                    continue
            out[name] = self.ends[name][1]
        return out

    def partitions(self, start, end):
        store, files = self._files()
        ranges = []
        for index, name in enumerate(sorted(end)):
            if name not in files:
                continue
            stop, head = end[name]
            at, known = start.get(name, (0, ""))
            if stop < at or not head.startswith(known):
                at = 0
            first = True
            while at < stop:
                cut = min(at + self.split, stop)
                ranges.append(InputPartition((index, files[name].path, at, cut, first)))
                at, first = cut, False
        return ranges

    def read(self, part):
        index, path, at, stop, opens = part.value
        store, _ = fs.FileSystem.from_uri(self.where)
        name = path.rsplit("/", 1)[-1]
        try:
            file = store.open_input_file(path)
        except FileNotFoundError:
            return
        with file:
            # The line that runs into a later range belongs to the one before: it is read from its last byte on.
            lines = _lines(file, at if opens else at - 1, stop)
            if not opens:
                next(lines, None)
            for line in lines:
                yield (index, name, line.rstrip(b"\r").decode("utf-8"))

    def commit(self, end):
        pass


def _lines(file, at: int, stop: int):
    """Lines that begin in [at, stop), without their line feeds; blocks are read one after the other, each once."""
    file.seek(at)
    rest: list[bytes] = []
    while at < stop:
        block = file.read(_BLOCK)
        if not block:
            if rest:
                yield b"".join(rest)
            return
        *ended, last = block.split(b"\n")
        for part in ended:
            if at >= stop:
                return
            line = b"".join([*rest, part])
            rest = []
            at += len(line) + 1
            yield line
        if last:
            rest.append(last)


def _head(store, path: str, end: int) -> str:
    with store.open_input_file(path) as file:
        return file.read(min(_HEAD, end)).hex()


def _end_of_last_line(store, info) -> int:
    """Position after the last line feed, searched from the end."""
    at = info.size
    with store.open_input_file(info.path) as file:
        while at > 0:
            first = max(0, at - _BLOCK)
            file.seek(first)
            cut = file.read(at - first).rfind(b"\n")
            if cut >= 0:
                return first + cut + 1
            at = first
    return 0


class TailSource(DataSource):
    """Option path: a folder URI (local, hdfs or s3) whose files are followed as they grow."""

    @classmethod
    def name(cls):
        return "tidemill_tail"

    def schema(self):
        return "source int, file string, line string"

    def streamReader(self, schema):
        return _TailReader(self.options)
