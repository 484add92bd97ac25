"""Files that tasks write and Spark reads back.

A task writes under a name of its own and renames when it is complete, so a retried or doubled task leaves one whole
file. Folders are URIs; pyarrow opens local paths and the object stores and file systems it knows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


@contextmanager
def writing(folder: str, name: str) -> Iterator[BinaryIO]:
    """Stream of a new file ``name``; it appears when the block ends without an error."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/_{name}.{os.getpid()}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, f"{path}/{name}")


def contents(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, content) of the files of a folder, one row each."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", "content")
