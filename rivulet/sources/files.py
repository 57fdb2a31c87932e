"""Files behind the library's own data sources and sinks, reached through pyarrow's file systems
(local and shared folders, and the stores that pyarrow knows by their URI)."""

from __future__ import annotations


def open_store(path: str):
    """``(file system, path within it)`` of a path or URI."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
    return fs.LocalFileSystem(), path


def listed(path: str) -> list[tuple[str, int, int]]:
    """``(path, bytes, modification time in ns)`` of the visible files at or under ``path``, by time and
    path.  Names that begin with ``_`` or ``.`` are left out."""
    from pyarrow import fs

    store, root = open_store(path)
    info = store.get_file_info(root)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    base = root.rstrip("/")
    visible = [f for f in found if f.type == fs.FileType.File and not any(part[:1] in "_." for part in f.path[len(base):].split("/") if part)]
    return sorted(((f.path, f.size, f.mtime_ns or 0) for f in visible), key=lambda f: (f[2], f[0]))
