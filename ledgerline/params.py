"""Run parameters, bound once on the driver and used as literals.

The procedure computes its dates from one clock reading; we take the same
approach so every stage sees the very same ``current_ts`` (equality on
ReportDate depends on it).
"""

from __future__ import annotations

import calendar
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta


def add_months(ts: datetime, months: int) -> datetime:
    """Calendar month arithmetic that clamps to month end (31 Mar - 1 month = 28/29 Feb)."""
    month_index = ts.month - 1 + months
    year = ts.year + month_index // 12
    month = month_index % 12 + 1
    day = min(ts.day, calendar.monthrange(year, month)[1])
    return ts.replace(year=year, month=month, day=day)


@dataclass(frozen=True)
class RunParams:
    current_ts: datetime = datetime(1998, 7, 1)
    department_id: int | None = None
    employee_id: int | None = None
    run_user: str = "etl_user"
    run_id: str = field(default="00000000-0000-0000-0000-000000000001")

    @staticmethod
    def fresh(current_ts: datetime | None = None, **kw) -> "RunParams":
        """Parameters for a real run: clock now (if not given) and a new run id."""
        return RunParams(current_ts=current_ts or datetime.now().replace(microsecond=0),
                         run_id=str(uuid.uuid4()), **kw)

    @property
    def previous_month(self) -> datetime:
        return add_months(self.current_ts, -1)

    @property
    def process_year(self) -> int:
        return self.current_ts.year

    @property
    def process_month(self) -> int:
        return self.current_ts.month

    @property
    def year_start(self) -> datetime:
        """`DATEFROMPARTS(YEAR(@CurrentDate), 1, 1)`."""
        return datetime(self.current_ts.year, 1, 1)

    @property
    def year_end(self) -> datetime:
        """`DATEFROMPARTS(YEAR(@CurrentDate), 12, 31)`."""
        return datetime(self.current_ts.year, 12, 31)

    def days_before(self, days: int) -> datetime:
        return self.current_ts - timedelta(days=days)


DEFAULT_PARAMS = RunParams()
