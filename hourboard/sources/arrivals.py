"""Which files of a request log have arrived, and which days they bring requests for.

Requests may reach the log after their day was loaded. An :class:`ArrivalIndex` keeps what files it has seen, by path,
length and time of change; :meth:`ArrivalIndex.update` looks for others, reads only these, and notes
the days of the completed plays in them. These are the days to load again, and stay pending until they are
settled. A file that was changed counts as new; the days of its plays before the change are not looked for.

Below the place of the index lies one folder for each arrival, with the files and the days. It is written aside and
renamed when complete, so an update that dies leaves none, and the next one finds the same files again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.functions import times
from hourboard.operators import tracking
from hourboard.schemas import is_ntz
from hourboard.sources.readers import read_requests

#: Files that are read in one job, so that their paths are all the driver holds.
FILES_AT_ONCE = 10_000
FILES = "path string, length bigint, modified timestamp"
DAYS = "dt date, plays bigint"


@dataclass(frozen=True)
class Arrival:
    """A batch of new files: how many they are, and the plays they hold by local day."""

    name: str
    files: int
    plays: dict[dt.date, int]


class ArrivalIndex:
    def __init__(self, spark: SparkSession, place: str, zone: str = times.TOKYO):
        self.spark, self.place, self.zone = spark, place.rstrip("/"), zone
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.place).getFileSystem(spark._jsc.hadoopConfiguration())

    def update(self, source: str, fmt: str) -> list[Arrival]:
        """The arrivals of the files below ``source`` that are not known yet, now noted; none if there is no new file."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
        listed = listed.select("path", "length", F.col("modificationTime").alias("modified"))
        unknown = listed.join(self.files(), ["path", "length", "modified"], "left_anti")
        found, paths = [], unknown.orderBy("modified", "path").toLocalIterator()
        while some := list(islice(paths, FILES_AT_ONCE)):
            found.append(self._note([tuple(row) for row in some], fmt))
        return found

    def _note(self, files: list[tuple], fmt: str) -> Arrival:
        plays = plays_per_day(read_requests(self.spark, [path for path, _, _ in files], fmt), self.zone)
        name, staged = uuid.uuid4().hex, f"{self.place}/.{uuid.uuid4().hex}"
        self.spark.createDataFrame(files, FILES).write.parquet(f"{staged}/files")
        plays.write.parquet(f"{staged}/days")
        counts = dict(self.spark.read.schema(DAYS).parquet(f"{staged}/days").collect())  # one row a day
        self._files.mkdirs(self._path(f"{self.place}/arrivals"))
        if not self._files.rename(self._path(staged), self._path(f"{self.place}/arrivals/{name}")):
            raise OSError(f"Cannot note an arrival: {self.place}")
        return Arrival(name, len(files), counts)

    def _names(self, folder: str) -> set[str]:
        path = self._path(f"{self.place}/{folder}")
        return {s.getPath().getName() for s in self._files.listStatus(path)} if self._files.exists(path) else set()

    def _table(self, kind: str, schema: str, names: set[str]) -> DataFrame:
        paths = [f"{self.place}/arrivals/{name}/{kind}" for name in sorted(names)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def files(self) -> DataFrame:
        """``(path, length, modified)`` of all files known."""
        return self._table("files", FILES, self._names("arrivals"))

    def pending(self) -> set[str]:
        """The arrivals that are not settled."""
        return self._names("arrivals") - self._names("settled")

    def days(self, names: set[str]) -> DataFrame:
        """``(dt, plays)``: the days that arrivals touch and how many plays they bring."""
        return self._table("days", DAYS, names).groupBy("dt").agg(F.sum("plays").alias("plays"))

    def settle(self, names: set[str]) -> None:
        """Their days are loaded: nothing of these arrivals is pending any more."""
        for name in names:
            self._files.mkdirs(self._path(f"{self.place}/settled/{name}"))


def plays_per_day(requests: DataFrame, zone: str = times.TOKYO) -> DataFrame:
    """``(dt, plays)``: completed plays by local day. What falls out of every day's window is not counted."""
    local = times.local_ts(F.col("timestamp"), is_ntz(requests, "timestamp"), zone)
    plays = requests.where(tracking.is_tracking_url(tracking.request_url())).select(local.alias("local"))
    day = times.business_date(F.col("local"))
    inside = F.col("local") <= day.cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return plays.where(inside).groupBy(day.alias("dt")).agg(F.count(F.lit(1)).alias("plays"))
