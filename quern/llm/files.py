"""Binary files in the shared folder, written and read by executors.

Files are opened through pyarrow's file systems, by URI, so the folder can be a local path that all
executors see or any store that pyarrow knows. A file is written under a name of its task attempt and
renamed when it is whole: a lost or repeated attempt leaves no half file under a final name.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def new_file(uri: str) -> Iterator:
    """A stream whose bytes are at uri once the block has ended well."""
    store, path = _at(uri)
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


class Reader:
    """Ranges of one file."""

    def __init__(self, uri: str) -> None:
        store, path = _at(uri)
        self.file = store.open_input_file(path)

    def read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        found = self.file.read(length)
        if len(found) != length:
            raise EOFError(f"{len(found)} of {length} bytes at {offset}")
        return found

    def close(self) -> None:
        self.file.close()
