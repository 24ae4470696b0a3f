"""Small files and sets of outputs on any file system that Spark can reach, through Hadoop's interface.

Several outputs that belong together are written into a new folder beside their places and put there by a journal: one
file, renamed into place, that lists them.  Until it stands, readers find the old set, whatever was written so far; once it
stands, whoever comes next (:func:`recover`) ends the moves, and finds the new set.  Moves may be repeated at will.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

JOURNAL = "_outputs.json"


def _path(path: str):
    """A Hadoop path and the file system that it lies on; a path without a scheme lies on the session's default one."""
    sc = SparkSession.active().sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    # local files without checksum files beside them, which would outlast an edit by other means
    return (fs.getRawFileSystem() if fs.getUri().getScheme() == "file" else fs), p


@contextmanager
def _as_os_errors(path: str) -> Iterator[None]:
    try:
        yield
    except Py4JJavaError as e:
        kind = e.java_exception.getClass().getName()
        if kind.endswith("FileNotFoundException"):
            raise FileNotFoundError(f"nothing at {path}") from e
        raise OSError(f"{path}: {e.java_exception.getMessage() or kind}") from e


def exists(path: str) -> bool:
    fs, p = _path(path)
    return fs.exists(p)


def move(source: str, target: str) -> None:
    """A file to its place in one step, over what stands there."""
    jvm = SparkSession.active().sparkContext._jvm
    fs, p = _path(source)
    with _as_os_errors(target):
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        over = SparkSession.active().sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(p), fs.makeQualified(_path(target)[1]), over)


def write_bytes(data: bytes, path: str) -> None:
    """Under another name first, so that readers see the old file or the new one."""
    folder, _, name = path.rpartition("/")
    temporary = f"{folder}/.{name}.{uuid4().hex}" if folder else f".{name}.{uuid4().hex}"
    fs, p = _path(temporary)
    with _as_os_errors(path):
        try:
            out = fs.create(p, True)
            try:
                out.write(bytearray(data))
            finally:
                out.close()
            move(temporary, path)
        except BaseException:
            fs.delete(p, False)
            raise


def write_text(text: str, path: str) -> None:
    write_bytes(text.encode(), path)


def read_bytes(path: str) -> bytes:
    """A whole small file: a document or a model's numbers."""
    fs, p = _path(path)
    with _as_os_errors(path):
        stream = fs.open(p)
        try:
            return bytes(SparkSession.active().sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()


def read_text(path: str) -> str:
    return read_bytes(path).decode()


def sha256(path: str) -> str:
    """Of a file of any size: the bytes stream through the JVM."""
    fs, p = _path(path)
    with _as_os_errors(path):
        stream = fs.open(p)
        try:
            return SparkSession.active().sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()


def recover(folder: str) -> None:
    """Ends the moves that a journal in the folder tells of; nothing where there is none."""
    if not exists(f"{folder}/{JOURNAL}"):
        return
    try:
        told = json.loads(read_text(f"{folder}/{JOURNAL}"))
    except FileNotFoundError:  # another reader has just ended them
        return
    staged = f"{folder}/{told['staged']}"
    for name in told["outputs"]:
        fs, new = _path(f"{staged}/{name}")
        if fs.exists(new):  # else it was moved before
            _, place = _path(f"{folder}/{name}")
            with _as_os_errors(f"{folder}/{name}"):
                fs.delete(place, True)
                if not fs.rename(new, place) and fs.exists(new):
                    raise OSError(f"{folder}/{name} could not be put in place")
    # files that Spark and Hadoop leave beside them go with the folder; the journal goes last
    for path in (staged, f"{folder}/{JOURNAL}"):
        fs, p = _path(path)
        fs.delete(p, True)


@contextmanager
def together(folder: str) -> Iterator[str]:
    """A new folder to write outputs into, which take their places in ``folder`` together when the block ends; after an error none does.  Other files of ``folder`` stay."""
    recover(folder)
    name = f"_staged-{uuid4().hex}"
    staged = f"{folder}/{name}"
    fs, p = _path(staged)
    with _as_os_errors(staged):
        fs.mkdirs(p)
    try:
        yield staged
        outputs = sorted(s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith("."))
        write_text(json.dumps({"staged": name, "outputs": outputs}), f"{folder}/{JOURNAL}")
    except BaseException:
        fs.delete(p, True)
        raise
    recover(folder)
