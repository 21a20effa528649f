"""Which batches of a stored table count: commit markers beside the data.

A batch's rows lie in folders ``dt=<day>/batch_id=<attempt>``, an attempt being
the batch's name and a tag of its own (``s-<run>-0000000003.1f0c22ab``). They count
once ``_commits/<attempt>`` exists, which appears by one rename; folders of an
attempt without a marker are invisible. A commit that takes other folders'
place (a replay, a compacted day, an expired day) lists them in its marker,
which is then named ``<attempt>+``: with that one rename the new rows appear and
the old ones go. The old folders are deleted afterwards, then the marker loses
its plus. Whatever step a writer dies at, every row counts once, and
``clean_up`` does what is left.

Folders whose batch has no tag (written by other means, SQL inserts for
instance) always count. Names only are listed, never data; markers with a plus
are the only ones read, and there are few.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import SparkSession

FOLDER = "_commits"
STAGING = "_staging"
_TAGGED = re.compile(r"\.[0-9a-f]{8}$")
_FOLDER_NAME = re.compile(r"dt=([^/,}\n]+)/batch_id=([^/,}\n]+)")


def new_attempt(batch: str) -> str:
    return f"{batch}.{uuid.uuid4().hex[:8]}"


def batch_of(attempt: str) -> str:
    return _TAGGED.sub("", attempt)


class CommitLog:
    """The markers of one table; every method works on names through the table's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.jvm = path.rstrip("/"), spark._jvm
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *[p for p in parts if p]]))

    def _names(self, pattern: str) -> str:
        """The paths that match, as one text (a call per path would be slow)."""
        found = self.fs.globStatus(self._at(pattern))
        paths = self.jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found) if found else None
        return self.jvm.org.apache.commons.lang3.ArrayUtils.toString(paths) if paths else ""

    def exists(self) -> bool:
        return self.fs.exists(self._at(FOLDER))

    def markers(self) -> set[str]:
        return set(re.findall(f"/{FOLDER}/" + r"([^/,}\n]+)", self._names(f"{FOLDER}/*")))

    def folders(self, days: str = "*") -> list[tuple[str, str]]:
        """(day, attempt or batch) of every folder on disk."""
        return _FOLDER_NAME.findall(self._names(f"dt={days}/batch_id=*"))

    def days(self) -> list[str]:
        return sorted(re.findall(r"/dt=([^/,}\n]+)", self._names("dt=*")))

    def drop_days(self, days: Iterable[str]) -> None:
        """Deletes whole day folders (whose batches have been replaced by a commit)."""
        for day in days:
            self.fs.delete(self._at(f"dt={day}"), True)

    def _replaced(self, marker: str) -> set[tuple[str, str]]:
        stream = self.fs.open(self._at(FOLDER, marker))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return set(_FOLDER_NAME.findall(text))

    def live(self, since: date | None = None) -> list[tuple[str, str]]:
        """(day, attempt) of the folders that count, from a day on."""
        markers = self.markers()
        gone = set().union(*[self._replaced(m) for m in markers if m.endswith("+")])
        known = {m.rstrip("+") for m in markers}
        return sorted((d, b) for d, b in self.folders()
                      if (since is None or d >= since.isoformat()) and (b in known or not _TAGGED.search(b))
                      and (d, b) not in gone)

    def location(self, day: str, attempt: str) -> str:
        return f"{self.path}/dt={day}/batch_id={attempt}"

    # -- writing --------------------------------------------------------------------------------------------------

    def begin(self, batch: str) -> bool:
        """Notes that a batch is being written; whether it had been begun before."""
        note = self._at(STAGING, f"{batch}.begun")
        if self.fs.exists(note) or self._names(f"{FOLDER}/{batch}.*"):
            return True
        self.fs.create(note, True).close()
        return False

    def staged(self, attempt: str) -> str:
        return str(self._at(STAGING, attempt).toString())

    def move_in(self, attempt: str) -> list[str]:
        """Staged day folders go to their places, where they do not count yet; the days."""
        days = re.findall(r"/dt=([^/,}\n]+)", self._names(f"{STAGING}/{attempt}/dt=*"))
        for day in days:
            self.fs.mkdirs(self._at(f"dt={day}"))
            if not self.fs.rename(self._at(STAGING, attempt, f"dt={day}"), self._at(f"dt={day}", f"batch_id={attempt}")):
                raise OSError(f"could not move day {day} of {attempt}")
        self.fs.delete(self._at(STAGING, attempt), True)
        return days

    def commit(self, attempt: str, replaces: Iterable[tuple[str, str]] = ()) -> None:
        """From here on the attempt's folders count, and those it replaces do not."""
        text = "".join(f"dt={d}/batch_id={b}\n" for d, b in sorted(replaces))
        draft = self._at(STAGING, f"{attempt}.draft")
        out = self.fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.fs.mkdirs(self._at(FOLDER))
        if not self.fs.rename(draft, self._at(FOLDER, attempt + "+" * bool(text))):
            raise OSError(f"could not commit {attempt}")

    def attempts(self, batch: str) -> set[tuple[str, str]]:
        """Folders of a batch's attempts, whatever their day and whether they count or not."""
        return {(d, b) for d, b in self.folders() if b == batch or batch_of(b) == batch and _TAGGED.search(b)}

    def clean_up(self) -> None:
        """Deletes replaced folders, then the markers that name nothing any more.

        All folders go before any marker does: a commit that was itself
        replaced still hides what it had replaced.
        """
        replacing = sorted(m for m in self.markers() if m.endswith("+"))
        gone = set().union(*map(self._replaced, replacing))
        for day, attempt in gone:
            self.fs.delete(self._at(f"dt={day}", f"batch_id={attempt}"), True)
        left = {b for _, b in self.folders()}
        for marker in replacing:
            if marker[:-1] in left:
                self.fs.rename(self._at(FOLDER, marker), self._at(FOLDER, marker[:-1]))
            else:
                self.fs.delete(self._at(FOLDER, marker), False)
        for attempt in {b for _, b in gone} - left:
            self.fs.delete(self._at(FOLDER, attempt), False)

    def finished(self, batch: str) -> None:
        self.fs.delete(self._at(STAGING, f"{batch}.begun"), False)

    def size(self, folders: Iterable[tuple[str, str]]) -> int:
        """Bytes of some folders."""
        return sum(self.fs.getContentSummary(self._at(f"dt={d}", f"batch_id={b}")).getLength() for d, b in folders)
