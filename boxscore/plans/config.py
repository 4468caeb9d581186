"""Pipeline parameters. The reference's variants differ only in these
values (question set, unit question, constants, date mode, goal keys)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from boxscore.functions.calendar import default_window
from boxscore.sources import lookups as L


@dataclass(frozen=True)
class ExtractConfig:
    start: str = "1995-07-01"          # fixed report window (inclusive); ``rolling`` gives the default one
    end: str = "2001-06-30"
    as_of: str = "2002-01-01"          # 'today' for ages; a parameter, never the clock
    questions: tuple = (1, 2, 3, 4, 5, 6, 7)
    age_question: int = L.AGE_QUESTION
    unit_question: int = L.UNIT_QUESTION
    designator_code: str = "PC"
    designator_source: str = "fact"    # "fact" (own column) or "log" (latest load per survey and value)
    designator_dedup: bool = True      # log source: keep only the latest load per (survey, value)
    keep_null_designator: bool = True  # NULL designators pass the filter
    fy_source: str = "calendar"        # REC_FY from the received date's calendar row, or "answer" (fact FY)
    event_type: str = "Child Inpatient Survey"
    service_line_id: int = L.CHILD_SERVICE_LINE_ID
    service_line: str = L.CHILD_SERVICE_LINE
    sub_service_line: str = L.CHILD_SUB_SERVICE_LINE
    date_mode: str = "left"

    @classmethod
    def rolling(cls, as_of: str, **changes) -> "ExtractConfig":
        """The default window (F4) of an as-of date: 24 months back through the end of its month."""
        start, end = default_window(dt.date.fromisoformat(as_of))
        return cls(start=start.isoformat(), end=end.isoformat(), as_of=as_of, **changes)


DEFAULT = ExtractConfig()
