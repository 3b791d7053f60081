"""Binary files in the shared folder: written by tasks, committed by rename, so that retried and speculative attempts are harmless."""

from __future__ import annotations

import os
import re
import uuid


def _fs(uri: str):
    """A file system and the path in it. Plain paths and file: URIs are the mounted shared folder."""
    if re.match(r"file:", uri):
        return None, re.sub(r"^file:(//)?", "", uri)
    if "://" not in uri:
        return None, uri
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_file(uri: str):
    """A file for reading and seeking."""
    fs, path = _fs(uri)
    return open(path, "rb") if fs is None else fs.open_input_file(path)


class FolderWriter:
    """Writes a folder of files that appears under its final name only when complete.

    The first attempt that commits wins; any later attempt for the same folder is discarded. So readers see the
    files of exactly one attempt, whatever number of attempts ran.
    """

    def __init__(self, root: str, name: str):
        self.fs, path = _fs(root)
        self.final = f"{path}/{name}"
        self.tmp = f"{path}/_attempts/{name}-{uuid.uuid4().hex}"
        if self.fs is None:
            os.makedirs(self.tmp, exist_ok=True)
        else:
            self.fs.create_dir(self.tmp, recursive=True)

    def open(self, name: str):
        path = f"{self.tmp}/{name}"
        return open(path, "wb") if self.fs is None else self.fs.open_output_stream(path)

    def commit(self) -> None:
        if self.fs is None:
            try:
                os.rename(self.tmp, self.final)
            except OSError:
                if not os.path.isdir(self.final):
                    raise
                import shutil

                shutil.rmtree(self.tmp, ignore_errors=True)
        else:
            from pyarrow import fs

            if self.fs.get_file_info(self.final).type == fs.FileType.NotFound:
                self.fs.move(self.tmp, self.final)
            else:
                self.fs.delete_dir(self.tmp)
