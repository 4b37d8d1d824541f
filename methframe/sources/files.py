"""Files on any storage that pyarrow reaches (local, hdfs, s3, gs), opened where a task runs."""

from __future__ import annotations

import fnmatch
import posixpath

from pyarrow import fs as _fs

#: Bytes of a split by default.
SPLIT = 64 << 20


def located(path: str) -> tuple[_fs.FileSystem, str]:
    """(file system, path in it); a path without a scheme is local."""
    if path.startswith("file:"):
        return _fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return _fs.FileSystem.from_uri(path) if "://" in path else (_fs.LocalFileSystem(), path)


def _matches(store: _fs.FileSystem, pattern: str) -> list[str]:
    """Paths of a pattern with * ? [] in any of its parts, sorted."""
    found, parts = [""], pattern.split("/")
    for k, part in enumerate(parts):
        if not any(c in part for c in "*?["):
            found = [f"{at}/{part}" if k else part for at in found]
            continue
        kinds = (_fs.FileType.Directory,) if k + 1 < len(parts) else (_fs.FileType.Directory, _fs.FileType.File)
        found = [
            f"{at}/{posixpath.basename(info.path)}" if k else posixpath.basename(info.path)
            for at in found
            for info in store.get_file_info(_fs.FileSelector(at or ("/" if k else "."), allow_not_found=True))
            if info.type in kinds and fnmatch.fnmatchcase(posixpath.basename(info.path), part)
        ]
    return sorted(found)


def expand(paths: str) -> list[str]:
    """A comma-separated list with patterns, in order; the files of a pattern by name."""
    out: list[str] = []
    for p in paths.split(","):
        if any(c in p for c in "*?["):
            store, inner = located(p)
            head = p[: len(p) - len(inner)] if "://" in p else ""
            out += [head + x for x in _matches(store, inner)]
        else:
            out.append(p)
    if not out:
        raise FileNotFoundError(paths)
    return out


def size(path: str) -> int:
    store, inner = located(path)
    info = store.get_file_info(inner)
    if info.type != _fs.FileType.File:
        raise FileNotFoundError(path)
    return info.size


def exists(path: str) -> bool:
    store, inner = located(path)
    return store.get_file_info(inner).type == _fs.FileType.File


def opened(path: str):
    """A file for reading at any place."""
    store, inner = located(path)
    return store.open_input_file(inner)
