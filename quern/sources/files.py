"""Small files of tasks in a shared folder, through pyarrow's file systems: a local path that all executors see, or any store that pyarrow knows."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is local."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextlib.contextmanager
def whole_file(uri: str) -> Iterator:
    """A stream whose bytes are at uri once the block has ended well, in place of what was there; else nothing is."""
    store, path = store_of(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}"
    try:
        with store.open_output_stream(part) as out:
            yield out
        store.move(part, path)
    except BaseException:
        with contextlib.suppress(OSError):
            store.delete_file(part)
        raise


def files_in(uri: str) -> list[str]:
    """URIs of the files in a folder, in the order of their names, without hidden ones; none if it isn't there."""
    store, path = store_of(uri)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [f"{uri.rstrip('/')}/{x.base_name}" for x in sorted(found, key=lambda x: x.base_name) if x.is_file and not x.base_name.startswith((".", "_"))]
