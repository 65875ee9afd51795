"""Files that tasks write to and read from the shared folder.

A task writes under a name of its own (partition and attempt) and reports the
name in its result rows.  Only reported files are ever read, so a task that is
repeated or lost leaves at most a file that nobody looks at.  Stores are named
by URI, as Spark names them (file, hdfs, s3, gs ...).
"""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow.fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def own_name(folder: str, number: int, suffix: str) -> str:
    """A path in ``folder`` that no other task attempt uses."""
    from pyspark import TaskContext
    t = TaskContext.get()
    return f"{folder}/{t.partitionId():06d}-{t.taskAttemptId()}-{number:04d}{suffix}"


@contextmanager
def writer(uri: str):
    """A binary stream to a new file; its folder is made if need be."""
    store, path = resolve(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        yield out


def reader(uri: str):
    store, path = resolve(uri)
    return store.open_input_stream(path, compression=None)


def random_reader(uri: str):
    store, path = resolve(uri)
    return store.open_input_file(path)
