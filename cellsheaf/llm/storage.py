"""Files that tasks write themselves, in the folder that all executors share, through any file system pyarrow knows."""

from __future__ import annotations

import os
from contextlib import contextmanager, suppress

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or a plain path."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))


@contextmanager
def committed(store: fs.FileSystem, path: str, attempt: str):
    """A new file that gets its name once it is whole. Attempts of one task give the same bytes, so the last to come may win."""
    own = f"{path}.{attempt}.tmp"
    store.create_dir(os.path.dirname(path), recursive=True)
    try:
        with store.open_output_stream(own, compression=None) as out:
            yield out
        store.move(own, path)
    except BaseException:
        with suppress(OSError):
            store.delete_file(own)
        raise


def attempt_name() -> str:
    """A name that no other attempt of this or another task has."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{context.stageId()}-{context.partitionId()}-{context.taskAttemptId()}"
