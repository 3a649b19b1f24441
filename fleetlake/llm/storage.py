"""Binary files in the shared folder, written and read inside tasks.

Paths are URIs below the folder that the session names in
``spark.checkpoint.dir``; any store pyarrow can open will do.
"""

from __future__ import annotations

from pyarrow import fs


def _at(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def open_output(path: str):
    store, at = _at(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(at, compression=None, buffer_size=1 << 20)


def open_input(path: str):
    store, at = _at(path)
    return store.open_input_file(at)
