"""Which files of a batch table count: a committed list for each period.

A batch table keeps the rows of a batch below ``billing_year=/billing_month=/writer=/
batch_id=``. Compaction puts the batches of a period that are old enough into few files
below ``_compacted`` and commits a list that says so; the batches' own folders no longer
count from then on. The list with the highest number holds; readers take it once, so
they see a batch either in its folder or in the compacted files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import SparkSession

#: Year and month; None where an event has no time.
Period = tuple[int | None, int | None]
Batch = tuple[str, int]


class ListConflict(RuntimeError):
    """Somebody else committed a list of the period in the meantime."""


@dataclass(frozen=True)
class LiveList:
    """``covered``: by writer, the highest batch whose rows are in the compacted files of
    ``generation``. ``hidden``: covered batches that were written again; their compacted
    rows no longer count, and their folders do."""

    version: int = 0
    generation: int = 0
    covered: dict[str, int] = field(default_factory=dict)
    hidden: frozenset[Batch] = frozenset()

    def covers(self, batch: Batch) -> bool:
        return batch[1] <= self.covered.get(batch[0], -1)

    def has_folder(self, batch: Batch) -> bool:
        """Whether the batch's own folder counts."""
        return not self.covers(batch) or batch in self.hidden

    def hiding(self, batch: Batch) -> LiveList:
        return replace(self, hidden=self.hidden | {batch})


class Folders:
    """A few operations on the table's file system, on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.hadoop.Path("/".join([self.root, *filter(None, parts)]))

    def names(self, *parts: str) -> list[str]:
        """Of what lies in a folder; none if there is no such folder."""
        where = self.path(*parts)
        if not self.fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in self.fs.listStatus(where))

    def bytes(self, *parts: str) -> int:
        return self.fs.getContentSummary(self.path(*parts)).getLength()

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.path(*parts))

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)

    def make(self, *parts: str) -> None:
        self.fs.mkdirs(self.path(*parts))

    def move(self, source: str, target: str) -> None:
        """A file or folder as a whole."""
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} could not be moved to {target} below {self.root}")

    def copy(self, source: str, other: Folders, target: str) -> None:
        self.hadoop.FileUtil.copy(self.fs, self.path(source), other.fs, other.path(target), False, True, self.conf)

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> None:
        """A whole new file or none: written under another name and renamed, which fails
        where the name is taken."""
        target = self.path(*parts)
        draft = self.hadoop.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        context = self.hadoop.FileContext.getFileContext(target.toUri(), self.conf)
        try:
            context.rename(draft, target, options)
        except Exception as failure:
            self.fs.delete(draft, False)
            if self.fs.exists(target):
                raise ListConflict(str(target)) from failure
            raise


def of_name(name: str) -> str:
    """The value in a folder's name ``column=value``, as Spark escapes it."""
    return unquote(name.partition("=")[2])


#: What Spark names the folder of a null (fixed value).
OF_NULL = "__HIVE_DEFAULT_PARTITION__"


def _shown(number: int | None) -> str:
    return OF_NULL if number is None else str(number)


def _number(text: str) -> int | None:
    return None if text == OF_NULL else int(text)


def period_name(period: Period) -> str:
    return f"billing_year={_shown(period[0])}/billing_month={_shown(period[1])}"


def list_folder(period: Period) -> str:
    return f"_lists/{_shown(period[0])}-{_shown(period[1])}"


def compacted_folder(period: Period, generation: int) -> str:
    return f"_compacted/{period_name(period)}/generation={generation}"


def has_lists(folders: Folders) -> bool:
    return folders.exists("_lists")


def current_list(folders: Folders, period: Period) -> LiveList:
    committed = [n for n in folders.names(list_folder(period)) if n.endswith(".json")]
    if not committed:
        return LiveList()
    held = json.loads(folders.read(list_folder(period), committed[-1]))
    return LiveList(
        int(committed[-1].removesuffix(".json")),
        held["generation"],
        held["covered"],
        frozenset((writer, batch_id) for writer, batch_id in held["hidden"]),
    )


def commit(folders: Folders, period: Period, new: LiveList) -> LiveList:
    """Make ``new`` the period's list, unless another one was committed since the list
    was read from which it was made."""
    version = new.version + 1
    held = {"generation": new.generation, "covered": new.covered, "hidden": sorted(new.hidden)}
    folders.create(json.dumps(held), list_folder(period), f"{version:010d}.json")
    return replace(new, version=version)


def periods_of(folders: Folders) -> list[Period]:
    """Periods with batch folders or a list."""
    found = {
        (_number(of_name(year)), _number(of_name(month)))
        for year in folders.names()
        if year.startswith("billing_year=")
        for month in folders.names(year)
        if month.startswith("billing_month=")
    }
    listed = {tuple(map(_number, name.split("-"))) for name in folders.names("_lists")}
    return in_order(found | listed)


def in_order(periods: Iterable[Period]) -> list[Period]:
    return sorted(set(periods), key=lambda period: [-1 if x is None else x for x in period])


def batches_of(folders: Folders, period: Period) -> dict[Batch, str]:
    """Every batch folder of a period, live or not, with its place below the table."""
    top = period_name(period)
    found = {}
    for writer in folders.names(top):
        if writer.startswith("writer="):
            for batch in folders.names(top, writer):
                if batch.startswith("batch_id="):
                    found[of_name(writer), int(of_name(batch))] = f"{top}/{writer}/{batch}"
    return found


def batch_place(folders: Folders, period: Period, batch: Batch) -> str:
    """Where a batch's rows of a period lie, if it has any; no listing is needed."""
    escaped = folders.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch[0])
    return f"{period_name(period)}/writer={escaped}/batch_id={batch[1]}"


def live_folders(folders: Folders, period: Period, live: LiveList) -> dict[Batch, str]:
    return {b: place for b, place in batches_of(folders, period).items() if live.has_folder(b)}


def hide_rewritten(spark: SparkSession, path: str, batch: Batch, tries: int = 5) -> list[Period]:
    """Of a batch written again: its compacted rows stop to count and its new folders
    begin to, period by period. Returns the periods whose lists cover it."""
    folders = Folders(spark, path)
    covering = []
    for period in periods_of(folders) if has_lists(folders) else []:
        for attempt in range(tries):
            live = current_list(folders, period)
            if not live.covers(batch):
                break
            if batch not in live.hidden:
                try:
                    commit(folders, period, live.hiding(batch))
                except ListConflict:
                    if attempt + 1 == tries:
                        raise
                    continue
            covering.append(period)
            break
    return covering


def wanted_periods(folders: Folders, periods: Iterable[Period] | None) -> list[Period]:
    return periods_of(folders) if periods is None else in_order(periods)
