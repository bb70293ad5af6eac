"""Stage boundaries: a frame written once to shared storage and read back.

A staged frame is frozen. Record ids and sequence numbers taken from it stay the
same when an executor is lost and a task is run again, and nothing upstream (the
scorer in particular) is computed twice.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from dataclasses import dataclass, field
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@dataclass
class Journal:
    """Which stages of a job are finished: one small file each, named by its part of the job, its name and its turn."""

    folder: str
    part: str = "start"
    turns: Counter = field(default_factory=Counter)

    def next(self, name: str) -> int:
        self.turns[self.part, name] += 1
        return self.turns[self.part, name]

    def entry(self, name: str) -> str:
        return f"{self.folder}/{self.part}-{name}-{self.next(name)}.json"


_JOURNAL: ContextVar[Journal | None] = ContextVar("journal", default=None)


def stage_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only a local session (tests) may go without that setting.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _LOCAL_ROOT:
        _LOCAL_ROOT[sc.applicationId] = tempfile.mkdtemp(prefix="ledgerlink-")
    return _LOCAL_ROOT[sc.applicationId]


def _path(spark: SparkSession, path: str):
    """A path and its store, for the few steps Spark has no reader or writer for."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _path(spark, path)
    return store.exists(where)


@dataclass(frozen=True)
class Entry:
    """A file or folder, when it was last changed (seconds), and its path without a scheme."""

    name: str
    path: str
    folder: bool
    changed: float


def listed(spark: SparkSession, path: str) -> list[Entry]:
    """What a folder holds; nothing if it does not exist."""
    where, store = _path(spark, path)
    if not store.exists(where):
        return []
    found = store.listStatus(where)
    return [
        Entry(f.getPath().getName(), f.getPath().toUri().getPath(), f.isDirectory(), f.getModificationTime() / 1000)
        for f in found
    ]


def plain_path(spark: SparkSession, path: str) -> str:
    """The path without its scheme, as ``listed`` gives it."""
    return _path(spark, path)[0].toUri().getPath()


def last_change(spark: SparkSession, path: str) -> float:
    """When anything in a folder was last changed, the folder itself included."""
    where, store = _path(spark, path)
    changed = [store.getFileStatus(where).getModificationTime() / 1000]
    return max([*changed, *(last_change(spark, _like(path, e)) if e.folder else e.changed for e in listed(spark, path))])


def _like(path: str, entry: Entry) -> str:
    return f"{path.rstrip('/')}/{entry.name}"


def remove(spark: SparkSession, path: str) -> None:
    where, store = _path(spark, path)
    store.delete(where, True)


def create_once(spark: SparkSession, path: str, text: str, link: bool = True) -> bool:
    """Make a file with this text, whole from the start; False if the name is taken.

    Written under another name first and then moved there in one step that fails if the target exists: a hard link on a
    file system of this machine (or one mounted there), else the store's rename without overwriting, which is atomic on
    HDFS. Stores without such a rename give no protection.
    """
    where, store = _path(spark, path)
    draft = f"{path.rsplit('/', 1)[0]}/_draft-{uuid.uuid4().hex}"
    source = _path(spark, draft)[0]
    out = store.create(source, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    try:
        if link and store.getUri().getScheme() == "file":
            os.link(source.toUri().getPath(), where.toUri().getPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(source, where, options)
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        store.delete(source, False)
    return True


def sweep_stages(spark: SparkSession, older_than: timedelta) -> list[str]:
    """Remove the stages of runs and single calls in which nothing changed for so long, such as those of killed runs.

    The age must be longer than the longest pause between two stages of a run.
    """
    limit, gone = time.time() - older_than.total_seconds(), []
    top = f"{stage_root(spark)}/ledgerlink"
    folders = [f"{top}/{e.name}" for e in listed(spark, top) if e.name != "single"]
    folders += [f"{top}/single/{e.name}" for e in listed(spark, f"{top}/single")]
    for folder in folders:
        if last_change(spark, folder) < limit:
            remove(spark, folder)
            gone.append(folder)
    return gone


class OtherJob(ValueError):
    """A job of this name began with other input or settings."""


@contextmanager
def stages_of(spark: SparkSession, run: str, made_of: Mapping[str, object] | None = None) -> Iterator[None]:
    """Stages written inside go to the run's own folder, which is removed at the end, however it ends.

    With ``made_of`` (what the stages depend on) the folder stays if the run fails, and a run of the same name takes up the
    stages that were finished. ``OtherJob`` is raised if that one was made of something else. Steps between
    stages must be the same each time they are run. Of two runs of one name at once, the first to finish a stage decides it for both,
    and the first to end takes the folder away, which ends the other.
    """
    folder = f"{stage_root(spark)}/ledgerlink/{run}"
    journal = None if made_of is None else Journal(f"{folder}/journal")
    if journal:
        text = json.dumps(made_of, sort_keys=True, default=str)
        if not create_once(spark, f"{journal.folder}/job.json", text) and _text(spark, f"{journal.folder}/job.json") != text:
            raise OtherJob(f"job {run} began with other input or settings; name this one otherwise")
    tokens = _RUN.set(run), _JOURNAL.set(journal)
    failed = True
    try:
        yield
        failed = False
    finally:
        _RUN.reset(tokens[0])
        _JOURNAL.reset(tokens[1])
        if not (failed and journal):
            remove(spark, folder)


def part_of_job(name: str) -> None:
    """The stages that follow belong to another part of the job: they are taken up only by the same part."""
    if journal := _JOURNAL.get():
        journal.part = name


def together[T](spark: SparkSession, *steps: Callable[[], T]) -> list[T]:
    """What steps give that need nothing of each other: their jobs share the executors, so none waits for another's last tasks.

    Each step has its own part of a job's journal. All have ended when this returns or raises what the first failed one raised.
    """
    journal = _JOURNAL.get()
    base = f"{journal.part}-{journal.next('together')}" if journal else ""

    def begin(turn: int, step: Callable[[], T]) -> T:
        if journal:
            _JOURNAL.set(Journal(journal.folder, f"{base}-{turn}"))
        return step()

    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(copy_context().run), begin, n, s) for n, s in enumerate(steps)]
    return [r.result() for r in running]


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def file_marks(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """Path, bytes and time of the last change of files."""
    status = (store.getFileStatus(where) for where, store in (_path(spark, p) for p in sorted(paths)))
    return [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in status]


def stage_path(spark: SparkSession, name: str) -> str:
    """A path nothing else has, in the folder of the surrounding ``stages_of`` (``single`` if there is none)."""
    return f"{stage_root(spark)}/ledgerlink/{_RUN.get() or 'single'}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` and continue from the written copy, in a folder no other stage has."""
    return stage_noted(df, name, dict, by)[0]


def stage_noted(df: DataFrame, name: str, note: Callable[[], dict], by: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """``stage``, and what was found while writing it (a small JSON object), which is kept with a finished stage."""
    spark, journal = df.sparkSession, _JOURNAL.get()
    entry = journal.entry(name) if journal else None
    if entry and exists(spark, entry):
        done = json.loads(_text(spark, entry))
    else:
        done = {"path": stage_path(spark, name)}
        df.write.partitionBy(*by).parquet(done["path"])
        done["note"] = note()
        if entry and not create_once(spark, entry, json.dumps(done)):
            done = json.loads(_text(spark, entry))
    columns = [c for c in df.columns if c not in by]
    return spark.read.schema(df.select(*columns, *by).schema).parquet(done["path"]), done["note"]
