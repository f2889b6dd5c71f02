"""The last named author of each user, carried through a stream.

State of a user: the named authors of the last ``HORIZON`` of the user's own time, in order, and the
greatest one before that. A row takes the last named author at or before its own place
(time, then id), so rows that come late, within the horizon, are resolved as if they had come
in time; what was given out before is not taken back, so a name that comes late changes only
the rows that come after it. A row that is older than the horizon takes the oldest name kept.
Rows that come again with the same time and id are resolved again, to the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.sequence import IDEM

HORIZON = timedelta(days=7)
NAMED = "ts timestamp, event_id long, author string"
RESOLVED = "event_id long, author string, resolved_author string"


class CarryAuthor(StatefulProcessor):
    """Rows (ts, event_id, author) of one user to (event_id, author, resolved author)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.names = handle.getListState("names", NAMED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = [tuple(x) for x in self.names.get()] if self.names.exists() else []
        own = sorted(((r["ts"], r["event_id"], r["author"]) for r in rows), key=lambda x: x[:2])
        known = sorted({*known, *(x for x in own if x[2] not in ("", IDEM, None))}, key=lambda x: x[:2])
        at, last = 0, None
        for ts, event_id, author in own:
            while at < len(known) and known[at][:2] <= (ts, event_id):
                last = known[at][2]
                at += 1
            yield Row(event_id=event_id, author=author, resolved_author=(last or IDEM) if author == IDEM else author)
        if known:
            least = known[-1][0] - HORIZON
            first = max((i for i, x in enumerate(known) if x[0] < least), default=0)
            self.names.put(known[first:])

    def close(self) -> None:
        pass


def carry_author(events: DataFrame, user: str = "user_id") -> DataFrame:
    """A stream of (``user``, ts, event_id, author) to one of ``RESOLVED``."""
    return events.groupBy(user).transformWithState(statefulProcessor=CarryAuthor(), outputStructType=RESOLVED, outputMode="Append", timeMode="None")
