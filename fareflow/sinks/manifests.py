"""Published versions of a stored table.

A table is a folder.  Data files lie in ``data/_gen=<generation>/`` and are never
changed.  Which of them make up the table is said by small files
``versions/<number>.json``; the largest number is the table as it is.

A writer puts its files aside in a generation of its own and then publishes the
next version in one rename that fails if that version is there already.  So a
reader sees the old state or the new one, a run that dies in between leaves the
old one, and of two writers at once the second one fails and may be run again.
A generation's name begins with the version it was written after: once that is
not the last version, a generation no version names will never be published.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published the version meanwhile; nothing was changed."""


@dataclass(frozen=True)
class Generation:
    """Files written together.  ``live`` lists the parts that still count, ``written`` how many there were."""

    name: str
    live: list[int]
    written: int


@dataclass(frozen=True)
class Version:
    """One published state of a table."""

    number: int
    day: str | None
    about: dict
    generations: list[Generation] = field(default_factory=list)


class Folder:
    """A table's folder, on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _names(self, name: str) -> list[str]:
        path = self._path(name)
        fs = path.getFileSystem(self._conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _delete(self, name: str) -> None:
        path = self._path(name)
        path.getFileSystem(self._conf).delete(path, True)

    def numbers(self) -> list[int]:
        """Numbers of the published versions, the oldest first."""
        return [int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and not n.startswith((".", "_"))]

    def version(self, number: int | None = None) -> Version | None:
        """A version, the last one if no number is given; None if there is none."""
        if number is None:
            number = max(self.numbers(), default=None)
            if number is None:
                return None
        path = self._path(f"versions/{number:012d}.json")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            found = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(**found | {"generations": [Generation(**g) for g in found["generations"]]})

    def generations(self) -> list[str]:
        """Names of the generations whose files are there, published or not."""
        return [n.removeprefix("_gen=") for n in self._names("data") if n.startswith("_gen=")]

    def parts(self, generation: str, column: str) -> list[int]:
        """The values of a partition column that a generation has folders for."""
        found = self._names(f"data/_gen={generation}")
        return sorted(int(n.split("=")[1]) for n in found if n.startswith(f"{column}="))

    def new_generation(self, last: Version | None) -> str:
        return f"{last.number if last else 0:012d}-{uuid.uuid4().hex}"

    def data(self, generation: str) -> str:
        return f"{self.root}/data/_gen={generation}"

    def publish(self, last: Version | None, generations: list[Generation], about: dict, day: date | None = None) -> Version:
        """Make ``generations`` the table, if ``last`` is still its last version."""
        number = last.number + 1 if last else 1
        made = Version(number, day.isoformat() if day else None, about, generations)
        aside, final = self._path(f"versions/_{uuid.uuid4().hex}"), self._path(f"versions/{number:012d}.json")
        out = aside.getFileSystem(self._conf).create(aside, True)
        out.write(json.dumps(asdict(made)).encode())
        out.close()
        # FileContext's rename refuses to replace a file; FileSystem's does so on some stores.
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(aside, final, options)
        except Py4JJavaError as refused:
            self._delete(f"versions/{aside.getName()}")
            if "FileAlreadyExists" in refused.java_exception.toString():
                raise Conflict(f"version {number} of {self.root} is there already") from None
            raise
        return made

    def expire(self, before: date) -> list[str]:
        """Delete versions dated before a day, but the last one, and the data that no other version names.

        First the versions go, then the data; a run that dies in between is completed
        by the next one.  Data that a writer may still publish stay.  Returns the
        names of the generations that were deleted.
        """
        numbers = self.numbers()
        kept = []
        for number in numbers:
            found = self.version(number)
            if number != numbers[-1] and found.day is not None and date.fromisoformat(found.day) < before:
                self._delete(f"versions/{number:012d}.json")
            else:
                kept.append(found)
        named = {g.name for v in kept for g in v.generations}
        last = numbers[-1] if numbers else 0
        gone = []
        for name in self.generations():
            if name not in named and int(name.split("-")[0]) < last:
                self._delete(f"data/_gen={name}")
                gone.append(name)
        return gone


def oldest_kept(run_date: date, keep: int) -> date:
    """The first day that a rule of ``keep`` days keeps: a state dated ``keep`` days before the run goes."""
    return run_date - timedelta(days=keep - 1)
