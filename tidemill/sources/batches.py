"""Tables that streams land one folder per batch, and their compaction.

``<path>/batch_id=<n>`` holds a batch; a batch that is run again replaces its folder.  Compaction is a plain batch job over
closed batches: it writes their rows to ``<path>/_compacted/<first>-<last>``, which counts from the moment its ``_SUCCESS``
mark is there, and then in place of the batches.  What it replaced is removed by the next compaction only, so that
a reader which listed the folders before is not disturbed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce as reduce_
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"
COMPACTED = "_compacted"
#: bytes of a compacted file, about
FILE_BYTES = 128 << 20
#: what opening a file is reckoned as when small files are packed
OPEN_BYTES = 64 << 10
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 64


@dataclass(frozen=True)
class Folder:
    """The rows of batches ``first`` to ``last``."""

    first: int
    last: int
    path: str
    compacted: bool


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that lands each batch in its own folder, so that a batch
    run again after a failure replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _found(spark: SparkSession, glob: str, pattern: str) -> list[tuple[str, ...]]:
    """What ``pattern`` finds in the names of the paths that ``glob`` matches: one call for any number of folders."""
    files, place = _hadoop(spark, glob)
    matched = files.globStatus(place)
    if not matched:
        return []
    jvm = spark._jvm
    listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(matched))
    return [m.groups() for m in re.finditer(pattern, listed)]


def _batches(spark: SparkSession, path: str) -> set[int]:
    """The numbers of all batches, complete or not."""
    return {int(n) for n, in _found(spark, f"{path}/{BATCH}=*", rf"/{BATCH}=(\d+)(?=[,}}])")}


def folders(spark: SparkSession, path: str) -> list[Folder]:
    """All complete folders of a table, compacted ones too that others have replaced."""
    single = _found(spark, f"{path}/{BATCH}=*/_SUCCESS", rf"/{BATCH}=(\d+)/_SUCCESS")
    merged = _found(spark, f"{path}/{COMPACTED}/*/_SUCCESS", rf"/{COMPACTED}/(\d+)-(\d+)/_SUCCESS")
    return [Folder(int(n), int(n), f"{path}/{BATCH}={n}", False) for n, in single] + [
        Folder(int(a), int(b), f"{path}/{COMPACTED}/{a}-{b}", True) for a, b in merged
    ]


def current(found: list[Folder]) -> list[Folder]:
    """The folders that hold every batch once: the widest compacted ones, and the batches that none of them has."""
    out: list[Folder] = []
    for f in sorted(found, key=lambda f: (f.first, -f.last, not f.compacted)):
        if not out or f.first > out[-1].last:
            out.append(f)
    return out


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all complete batches, each once, from compacted files where there are any."""
    parts = current(folders(spark, path))
    if not parts:
        raise ValueError(f"no batch has been written to {path}")
    return _read(spark, path, parts)


def _read(spark: SparkSession, path: str, parts: list[Folder]) -> DataFrame:
    """Single batches are found from the table's own folder, in one listing by few tasks; which of them are
    wanted is a filter on the folder's number."""
    single = sorted(f.first for f in parts if not f.compacted)
    merged = [f.path for f in parts if f.compacted]
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        out = [spark.read.parquet(*merged)] if merged else []
        if single:
            runs = [[single[0], single[0]]]
            for n in single[1:]:
                if n == runs[-1][1] + 1:
                    runs[-1][1] = n
                else:
                    runs.append([n, n])
            wanted = [F.col(BATCH).between(a, b) for a, b in runs]
            out.append(spark.read.parquet(path).filter(reduce_(or_, wanted)).drop(BATCH))
        return reduce_(lambda a, b: a.unionByName(b), out)
    finally:
        spark.conf.set(LISTING, before)


def compact_batches(
    spark: SparkSession,
    path: str,
    upto: int,
    reduce: Callable[[DataFrame], DataFrame] | None = None,
    file_bytes: int = FILE_BYTES,
) -> Folder | None:
    """Write the batches up to ``upto``, which must be closed, to files of about ``file_bytes``; ``None`` if there is
    nothing to do.

    Small files are packed by their bytes when Spark plans the scan, so rows are copied without a shuffle.  With
    ``reduce`` (the last row of each key, say) what was compacted before is read again and reduced with the new
    batches; without it only new batches are written.  First removes what earlier compactions have replaced.
    """
    remove_replaced(spark, path)
    now = current(folders(spark, path))
    # no further than a batch that did not end
    open_ = sorted(_batches(spark, path) - {n for f in now for n in range(f.first, f.last + 1)})
    upto = min([upto, *[n - 1 for n in open_[:1]]])
    closed = [f for f in now if f.last <= upto and (reduce or not f.compacted)]
    if not closed or (len(closed) == 1 and closed[0].compacted):
        return None
    first, last = closed[0].first, closed[-1].last
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(min(OPEN_BYTES, file_bytes)))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    rows = _read(own, path, closed)
    target = f"{path}/{COMPACTED}/{first}-{last}"
    (rows if reduce is None else reduce(rows)).write.mode("overwrite").parquet(target)
    return Folder(first, last, target, True)


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders whose batches a compacted one holds; how many there were."""
    found = folders(spark, path)
    kept = set(current(found))
    gone = [f for f in found if f not in kept]
    for f in gone:
        files, place = _hadoop(spark, f.path)
        files.delete(place, True)
    return len(gone)
