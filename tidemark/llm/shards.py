"""Binary shard files in the shared folder, written and read by tasks through pyarrow's file systems.

A shard has a name that depends only on its partition and appears under it by a rename once it is whole, so a task
that runs twice, or again on another executor, leaves the same file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class ShardWriter:
    def __init__(self, folder: str, name: str):
        self.fs, base = opened(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.own = f"{base}/{name}", f"{base}/_{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.own)

    def write(self, data) -> None:
        self.out.write(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.own, self.path)


def sizes(folder: str, suffix: str) -> list[tuple[str, int]]:
    """Names and sizes of the whole shards in a folder, by name: a listing, no contents."""
    system, base = opened(folder)
    found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.base_name.endswith(suffix) and not f.base_name.startswith("_"))


def read_range(folder: str, name: str, start: int, length: int) -> bytes:
    system, base = opened(folder)
    with system.open_input_file(f"{base}/{name}") as f:
        return f.read_at(length, start)
