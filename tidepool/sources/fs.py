"""Minimal Hadoop FileSystem helpers (rename/delete/exists) for publishing.

Publishing a staged batch is a directory rename on the cluster file
system: no data is copied, and the previous snapshot stays readable until
the new one is in place.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def input_bytes(spark: SparkSession, df) -> int:
    """Total size of the files a DataFrame scans (0 for non-file sources such as JDBC).

    One listing per parent directory, not one status call per file: at 100 TB
    an input has ~10^6 files but far fewer directories.
    """
    files = df.inputFiles()
    if not files:
        return 0
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    by_dir: dict[str, set[str]] = {}
    for f in files:
        parent, _, name = f.rpartition("/")
        by_dir.setdefault(parent, set()).add(unquote(name))   # inputFiles() gives URI-encoded paths
    total = 0
    for parent, names in by_dir.items():   # names are unique within one listed directory
        d = jvm.org.apache.hadoop.fs.Path(parent)
        for st in d.getFileSystem(conf).listStatus(d):
            if st.isFile() and st.getPath().getName() in names:
                total += st.getLen()
    return total


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s, jvm = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


POINTER = "_CURRENT"
#: In a snapshot's folder: the record of the job that made it. Readers skip names that begin with "_".
RECORD = "_RECORD"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace one small file: written under a name of its own, then renamed over ``path`` in one step."""
    fs, p, jvm = _fs(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(p), over)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _pointed(spark: SparkSession, target: str) -> list[str]:
    """The batch that ``target``'s pointer serves and, if there is one, the batch before it."""
    pointer = f"{target.rstrip('/')}/{POINTER}"
    return read_text(spark, pointer).split() if exists(spark, pointer) else []


def resolve(spark: SparkSession, target: str) -> str:
    """The folder currently served as ``target``: the batch its pointer names
    (pointer publishing), else ``target`` itself (rename publishing)."""
    served = _pointed(spark, target)
    if served:
        return served[0]
    recover(spark, target)
    return target


def batch_dir(target: str, batch: str) -> str:
    """Where a batch is written under pointer publishing (its final home)."""
    return f"{target.rstrip('/')}/_batches/{batch}"


def publish_pointer(spark: SparkSession, staged: str, target: str, keep_history: bool = False) -> None:
    """Swap ``target``'s pointer to ``staged`` (a folder below ``target/_batches``).

    No data moves: on object stores a directory rename is a copy of every object. The
    batch that was served stays for one cycle, for readers that have planned on it; the
    one before it is removed unless history is kept. Readers go through ``resolve``.
    """
    served = [b for b in _pointed(spark, target) if b != staged]
    write_text(spark, f"{target.rstrip('/')}/{POINTER}", "\n".join([staged, *served[:1]]))
    if not keep_history:
        for old in served[1:]:
            delete(spark, old)


ASIDE = ".__previous."


def _asides(spark: SparkSession, target: str) -> list[str]:
    """Side folders of ``target``, oldest first."""
    fs, p, _ = _fs(spark, target)
    parent = p.getParent()
    if not fs.exists(parent):
        return []
    found = [st.getPath() for st in fs.listStatus(parent) if st.getPath().getName().startswith(p.getName() + ASIDE)]
    return sorted((str(f.toString()) for f in found), key=lambda f: f.rpartition(ASIDE)[2])


def recover(spark: SparkSession, target: str) -> None:
    """After a stop between the two renames of ``publish``, put the last snapshot back."""
    if not exists(spark, target):
        asides = _asides(spark, target)
        if asides:
            rename(spark, asides[-1], target)


def publish(spark: SparkSession, staged: str, target: str, history: str | None = None) -> None:
    """Swap ``staged`` in as ``target``. The old target moves to ``history`` (kept) or to a side
    folder of its own name, which stays for one cycle; earlier ones are removed."""
    recover(spark, target)
    earlier = _asides(spark, target)
    aside = history or f"{target.rstrip('/')}{ASIDE}{time.time_ns():020d}.{uuid.uuid4().hex}"
    had_old = exists(spark, target)
    if had_old:
        if history and exists(spark, aside):
            delete(spark, aside)
        rename(spark, target, aside)
    try:
        rename(spark, staged, target)
    except Exception:
        if had_old:
            rename(spark, aside, target)
        raise
    for old in earlier:
        delete(spark, old)
