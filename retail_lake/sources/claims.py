"""One load at a time for targets on shared storage, which have no key of their own.

A load looks at the last claim before it reads the target's keys, and claims the next number
before it appends, by a file that only one load can create. A load that finds the next
number taken read keys that have changed since: it stops before the target is touched, as
a warehouse would stop it by its key.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

from retail_lake.storage import age_seconds, create_new, delete_folder, matching_names

#: Claims that are kept behind the last one.
KEPT = 50


class ConcurrentLoad(RuntimeError):
    """Another load of the target was there first; this one appended nothing."""


@dataclass(frozen=True)
class Claims:
    """The claims of one target, a folder beside it.

    A load whose driver died leaves an unfinished claim, and later loads refuse to start:
    nobody but its owner knows whether it still runs. ``release`` it once it is known to
    be dead, or set ``stale_after`` to an age that no load reaches.
    """

    folder: str
    stale_after: dt.timedelta | None = None

    @classmethod
    def beside(cls, path: str, stale_after: dt.timedelta | None = None) -> Claims:
        parent, _, name = path.rstrip("/").rpartition("/")
        return cls(f"{parent}/_claims_{name}", stale_after)

    def _file(self, number: int, kind: str) -> str:
        return f"{self.folder}/{number:09d}.{kind}"

    def _numbers(self, spark: SparkSession, kind: str) -> set[int]:
        names = matching_names(spark, f"{self.folder}/*.{kind}")
        return {int(n.partition(".")[0]) for n in names if re.fullmatch(rf"\d+\.{kind}", n)}

    def begin(self, spark: SparkSession) -> int:
        """The number of the last claim; the load that made it must be over."""
        last = max(self._numbers(spark, "claim"), default=0)
        if last and last not in self._numbers(spark, "done"):
            file = self._file(last, "claim")
            old = self.stale_after
            if old is None or age_seconds(spark, file) < old.total_seconds():
                raise ConcurrentLoad(f"{file} is not finished; release() it if its load is dead")
            self.finish(spark, last)
        return last

    def take(self, spark: SparkSession, seen: int) -> int:
        """Claim the number after ``seen``, what ``begin`` said before keys were read."""
        number = seen + 1
        owner = {
            "application": spark.sparkContext.applicationId,
            "at": dt.datetime.now(dt.timezone.utc).isoformat(),
        }
        if not create_new(spark, self._file(number, "claim"), json.dumps(owner)):
            raise ConcurrentLoad(f"another load claimed {self._file(number, 'claim')}")
        if max(self._numbers(spark, "claim")) > number:
            # The number was free only because old claims are deleted.
            delete_folder(spark, self._file(number, "claim"))
            raise ConcurrentLoad(f"other loads went past claim {number} of {self.folder}")
        return number

    def finish(self, spark: SparkSession, number: int) -> None:
        """The load's append is over, well or badly: what it wrote is there to be read."""
        create_new(spark, self._file(number, "done"), "")
        for old in sorted(self._numbers(spark, "claim")):
            if old <= number - KEPT:
                delete_folder(spark, self._file(old, "claim"))
                delete_folder(spark, self._file(old, "done"))

    def release(self, spark: SparkSession) -> bool:
        """Finish the last claim for a load that is known to be dead; says whether there
        was one to finish."""
        last = max(self._numbers(spark, "claim"), default=0)
        if not last or last in self._numbers(spark, "done"):
            return False
        self.finish(spark, last)
        return True
