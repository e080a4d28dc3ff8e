"""A data source of very many small files, each named by its rows.

``partitionBy`` gives a folder for each value as well, but opens its files one by one through
the file system of the JVM (three processes a file on a plain local disk) and keeps a status
object of every file on the driver when they are read.  Here a task writes the files of its
rows itself, and a reading task gets a list of names.

Rows are (folder string, content binary): what a partition holds for a folder, in its order,
becomes one file of that folder.  Files are staged by the tasks and moved to their folders when
the job commits, so a failed or repeated task leaves none.  Appending adds files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "keyed_files"
FOLDERS_A_TASK = 1000
BATCH_BYTES = 4 << 20
STAGED = "_staged-"


def use(spark: SparkSession) -> str:
    """The name for ``format``, registered in this session."""
    spark.dataSource.register(KeyedFiles)
    return FORMAT


def reaches(path: str) -> bool:
    """Whether tasks can open the store of ``path`` themselves."""
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return False
    return True


def folder_name(key: str) -> str:
    """A key as one path element, escaped as Spark escapes partition values."""
    special = "\"#%'*/:=?\\\x7f{}[]^"
    return "".join(f"%{ord(x):02X}" if x in special or x < " " else x for x in key)


class KeyedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "folder string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("files are appended only")
        return _Writer(self.options["path"], self.options.get("prefix", ""), self.options.get("suffix", ""))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


class _Done(WriterCommitMessage):
    def __init__(self, staged: str):
        self.staged = staged


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, prefix: str, suffix: str):
        self.path, self.prefix, self.suffix, self.run = path, prefix, suffix, uuid.uuid4().hex[:12]

    def _root(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Done:
        from pyspark import TaskContext

        store, root = self._root()
        task = TaskContext.get()
        staged = f"{STAGED}{self.run}/{task.partitionId():05d}-{task.taskAttemptId()}"
        store.create_dir(f"{root}/{staged}", recursive=True)
        current, out = None, None
        for batch in iterator:
            for folder, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if folder != current:
                    if out is not None:
                        out.close()
                    current, out = folder, store.open_output_stream(f"{root}/{staged}/{self.prefix}{folder_name(folder)}")
                out.write(content)
        if out is not None:
            out.close()
        return _Done(staged)

    def commit(self, messages: list[_Done | None]) -> None:
        """Moves the files, one task's at a time."""
        store, root = self._root()
        for message in messages:
            if message is None:
                continue
            part = message.staged.rpartition("/")[2].partition("-")[0]
            for file in store.get_file_info(fs.FileSelector(f"{root}/{message.staged}")):
                store.create_dir(f"{root}/{file.base_name}", recursive=True)
                store.move(file.path, f"{root}/{file.base_name}/part-{part}-{self.run}{self.suffix}")
        self.abort(messages)

    def abort(self, messages: list[_Done | None]) -> None:
        store, root = self._root()
        store.delete_dir_contents(f"{root}/{STAGED}{self.run}", missing_dir_ok=True)
        if store.get_file_info(f"{root}/{STAGED}{self.run}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{STAGED}{self.run}")


class _Folders(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(None)
        self.names = names


class _Reader(DataSourceReader):
    """The content of each file, in pieces of whole lines, with the name of its folder."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_Folders]:
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root))
        names = sorted(x.base_name for x in found if x.type == fs.FileType.Directory and x.base_name[0] not in "._")
        return [_Folders(names[i : i + FOLDERS_A_TASK]) for i in range(0, max(1, len(names)), FOLDERS_A_TASK)]

    def read(self, partition: _Folders) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(self.path)
        folders, contents, held = [], [], 0
        schema = pa.schema([("folder", pa.string()), ("content", pa.binary())])
        for name in partition.names:
            for file in store.get_file_info(fs.FileSelector(f"{root}/{name}")):
                with store.open_input_stream(file.path) as stream:
                    rest = b""
                    while piece := stream.read(BATCH_BYTES):
                        whole, end, rest = (rest + piece).rpartition(b"\n")
                        if end:
                            folders.append(name)
                            contents.append(whole + end)
                            held += len(whole)
                        if held >= BATCH_BYTES or len(folders) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(folders), pa.array(contents, pa.binary())], schema=schema)
                            folders, contents, held = [], [], 0
                    if rest:
                        folders.append(name)
                        contents.append(rest)
        if folders:
            yield pa.RecordBatch.from_arrays([pa.array(folders), pa.array(contents, pa.binary())], schema=schema)
