"""Binary files written and read by tasks, in any store that Arrow's file systems reach.

A task writes each file under a name of its own (so a retried or speculative attempt
never touches another's) and reports it as a row; only files in the stored report
count. Readers start from that report.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop's spellings of local and S3 paths are understood."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith("s3a://"):
        uri = "s3" + uri[len("s3a"):]
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    system, path = locate(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    system, path = locate(uri)
    return system.open_input_file(path)
