"""Series naming: the fixed text patterns of report files and series ids.

Fixed values (must stay as they are to read the reports):

* data line:        ``yyyy-MM-dd HH:mm:ss,<number or empty>``
* header line:      ``<TimeStamp>,<Parameter>@<Plate>``, after 11 lines of which one is the description
* description line: ``# <uid with hyphens> <Parameter>.<Label>@<Plate>: <Description>``
* series id:        ``<Parameter>.<Label>@<Plate>``
* time format:      ``yyyy-MM-dd HH:mm:ss``; dates ``yyyy-MM-dd``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A line that starts like a date is a reading, well formed or not.
DATA_LINE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
# The usual header, and any other line ``<time>,<Parameter>@<Plate>``.
HEADER_LINE = r"^TimeStamp,"
ANY_HEADER_LINE = r"^[^,#\d][^,]*,.+@[^@]*$"
DESC_LINE = r"^# [0-9A-Fa-f-]{32,36} "
PARAM_PLATE = r"^(.*)@([^@]*)$"
PREAMBLE_LINES = 10
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def split_series_name(token) -> tuple[Column, Column]:
    """``Parameter@Plate`` -> (Parameter, Plate): split at the last ``@``."""
    token = F.col(token) if isinstance(token, str) else token
    return (F.regexp_extract(token, PARAM_PLATE, 1), F.regexp_extract(token, PARAM_PLATE, 2))


def series_id(parameter, label, plate) -> Column:
    """``<Parameter>.<Label>@<Plate>``."""
    c = [F.col(x) if isinstance(x, str) else x for x in (parameter, label, plate)]
    return F.concat(c[0], F.lit("."), c[1], F.lit("@"), c[2])


def compact_uid(uid) -> Column:
    """Series unique id without hyphens (32 hex digits)."""
    uid = F.col(uid) if isinstance(uid, str) else uid
    return F.replace(uid, F.lit("-"), F.lit(""))


def format_ts(ts, daily: bool = False) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, DATE_FORMAT if daily else TIME_FORMAT)
