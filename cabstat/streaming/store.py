"""Files of logs and sinks, for Python processes with or without a Spark session.

Paths are on a store that the driver and all executors share (a mounted
folder, HDFS or an object store that pyarrow opens by URI). Publishing relies on
a rename that does not overwrite, as Spark's own checkpoints do.
"""

from __future__ import annotations

import json
import os
import re
import uuid

from pyarrow import fs as pafs


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system of a path or URI, and the path inside it."""
    bare = re.sub(r"^file:/+", "/", uri)
    if "://" not in bare:
        return pafs.LocalFileSystem(), bare.rstrip("/")
    found, path = pafs.FileSystem.from_uri(bare)
    return found, path.rstrip("/")


class Folder:
    """A folder of a shared store."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")
        self.fs, self.base = open_store(self.uri)

    # the file system is opened anew where the object is sent to
    def __getstate__(self):
        return self.uri

    def __setstate__(self, uri):
        self.__init__(uri)

    def at(self, name: str) -> str:
        return f"{self.base}/{name}"

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(self.at(name)).type != pafs.FileType.NotFound

    def names(self, name: str = "") -> list[str]:
        """Sorted names of what a folder holds; none if it does not exist."""
        found = self.fs.get_file_info(pafs.FileSelector(self.at(name), allow_not_found=True))
        return sorted(x.base_name for x in found)

    def read(self, name: str) -> bytes | None:
        """A file's bytes, None if there is no such file."""
        try:
            with self.fs.open_input_stream(self.at(name)) as f:
                return f.read()
        except FileNotFoundError:
            return None

    def read_json(self, name: str):
        found = self.read(name)
        return None if found is None else json.loads(found)

    def create(self, name: str):
        """An output stream; folders on the way are made."""
        self.fs.create_dir(os.path.dirname(self.at(name)), recursive=True)
        return self.fs.open_output_stream(self.at(name))

    def delete(self, name: str) -> None:
        """Delete a file or a folder, if it is there."""
        kind = self.fs.get_file_info(self.at(name)).type
        if kind == pafs.FileType.Directory:
            self.fs.delete_dir(self.at(name))
        elif kind == pafs.FileType.File:
            self.fs.delete_file(self.at(name))

    def move_if_absent(self, source: str, target: str) -> bool:
        """Rename a file unless the target exists; of several callers one succeeds."""
        self.fs.create_dir(os.path.dirname(self.at(target)), recursive=True)
        if isinstance(self.fs, pafs.LocalFileSystem):
            try:
                os.link(self.at(source), self.at(target))   # fails where the name is taken
            except FileExistsError:
                return False
            os.unlink(self.at(source))
            return True
        if self.exists(target):
            return False
        try:
            self.fs.move(self.at(source), self.at(target))
        except OSError:
            if self.exists(target):
                return False
            raise
        return True

    def put_if_absent(self, name: str, content: bytes) -> bool:
        """Write a whole file under a name that nobody has taken; False if it is taken."""
        folder, last = os.path.split(name)
        staged = os.path.join(folder, f".{last}.{uuid.uuid4().hex}")
        with self.create(staged) as f:
            f.write(content)
        if self.move_if_absent(staged, name):
            return True
        self.delete(staged)
        return False

    def put(self, name: str, content: bytes) -> None:
        """Write a whole file, in place of what had the name."""
        folder, last = os.path.split(name)
        staged = os.path.join(folder, f".{last}.{uuid.uuid4().hex}")
        with self.create(staged) as f:
            f.write(content)
        self.fs.move(self.at(staged), self.at(name))
