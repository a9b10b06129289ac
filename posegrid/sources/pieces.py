"""A data source that writes binary documents in pieces, with commit and abort.

A task writes its pieces into a folder of the job that no reader looks at, and names them in its message. Only when
all tasks have ended well, ``commit`` moves the named pieces to ``<key>=<document>/part-<task>.bin``; what a lost or
repeated task left is not named and goes with the job's folder. A job that fails leaves documents as they were.

Documents that one task holds from end to end may become a file each, ``<document><suffix>``, without a folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def file_system(path: str):
    """Arrow's file system of a path or URI, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


@contextmanager
def store_of(path: str):
    """A file opened for reads at any offset."""
    store, name = file_system(path)
    with store.open_input_file(name) as f:
        yield f


@dataclass
class Written(WriterCommitMessage):
    task: int
    #: (document, file) of every piece
    pieces: list[tuple[str, str]]


class PieceWriter(DataSourceWriter):
    def __init__(self, path: str, key: str, overwrite: bool, suffix: str = ""):
        self.store_path, self.key, self.overwrite, self.suffix = path, key, overwrite, suffix
        self.job = f"_pending-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        """Rows ``document, data`` in order; the data of one document that follow each other are one piece."""
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = file_system(self.store_path)
        folder = f"{root}/{self.job}/{context.taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        pieces: list[tuple[str, str]] = []
        out = None
        for document, data in iterator:
            if not pieces or pieces[-1][0] != document:
                if out is not None:
                    out.close()
                pieces.append((document, f"{folder}/{len(pieces):08d}.bin"))
                out = store.open_output_stream(pieces[-1][1])
            out.write(bytes(data))
        if out is not None:
            out.close()
        return Written(context.partitionId(), pieces)

    def commit(self, messages: list) -> None:
        store, root = file_system(self.store_path)
        from pyarrow import fs

        if self.suffix:
            named = [p for m in messages if m for p in m.pieces]
            if len({document for document, _ in named}) < len(named):
                raise ValueError("a document in several pieces can't be one file")
            for document, name in named:
                store.move(name, f"{root}/{quote(document, safe=' ')}{self.suffix}")
            self._clear()
            return
        cleared = set()
        for message in sorted((m for m in messages if m), key=lambda m: m.task):
            for document, name in message.pieces:
                folder = f"{root}/{self.key}={quote(document, safe=' ')}"
                if folder not in cleared:
                    cleared.add(folder)
                    there = store.get_file_info(folder).type is not fs.FileType.NotFound
                    if self.overwrite and there:
                        store.delete_dir(folder)
                    store.create_dir(folder, recursive=True)
                store.move(name, f"{folder}/part-{message.task:05d}.bin")
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, root = file_system(self.store_path)
        if store.get_file_info(f"{root}/{self.job}").type is not fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.job}")


class BinaryPieces(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binary_pieces"

    def writer(self, schema: StructType, overwrite: bool) -> PieceWriter:
        return PieceWriter(self.options["path"], self.options.get("key", "doc_id"), overwrite, self.options.get("suffix", ""))


def save_pieces(data: DataFrame, path: str, key: str, suffix: str = "") -> None:
    """Write ``document string, data binary`` rows, in order within and between partitions; documents that are there
    already are replaced. With ``suffix`` the rows of a document follow each other in one partition, and it is a file."""
    data.sparkSession.dataSource.register(BinaryPieces)
    data.write.format("binary_pieces").option("key", key).option("suffix", suffix).mode("overwrite").save(path)
