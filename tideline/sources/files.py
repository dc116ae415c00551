"""Small files on any filesystem that a URI names (``file://``, ``hdfs://``, ``s3://``, ...); a plain path is local."""

from __future__ import annotations

import re


def _open(uri: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", uri):
        return FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    return LocalFileSystem(), uri


def names(folder: str) -> list[str]:
    """Names of the files of a folder; none where there is no such folder."""
    from pyarrow.fs import FileSelector, FileType

    fs, path = _open(folder)
    return [f.base_name for f in fs.get_file_info(FileSelector(path, allow_not_found=True)) if f.type == FileType.File]


def exists(uri: str) -> bool:
    from pyarrow.fs import FileType

    fs, path = _open(uri)
    return fs.get_file_info(path).type == FileType.File


def size(uri: str) -> int:
    fs, path = _open(uri)
    return fs.get_file_info(path).size


def open_random(uri: str):
    fs, path = _open(uri)
    return fs.open_input_file(path)


def read(uri: str) -> bytes:
    with open_random(uri) as data:
        return data.read()


def open_write(uri: str):
    fs, path = _open(uri)
    return fs.open_output_stream(path, compression=None)


def make(folder: str) -> None:
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)


def move(source: str, target: str) -> None:
    fs, path = _open(source)
    fs.move(path, _open(target)[1])


def replace(uri: str, data: bytes) -> None:
    """Write a file as a whole; readers see the old one or the new one."""
    with open_write(uri + ".tmp") as out:
        out.write(data)
    move(uri + ".tmp", uri)
