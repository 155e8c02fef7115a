"""Typed configuration: table names, load windows, member filters, time specs.

Everything here is checked when it is built, on the driver, before any job
runs.  No value in this module touches data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

# --- fixed values: formats and names shared with the source system -----------
# Time text of watermarks and window bounds.
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"
# Run folders: <root>/<db>/<table>/<day>/<day>-<time>
RUN_DAY_FORMAT = "%Y_%m_%d"
RUN_STAMP_FORMAT = "%Y_%m_%d-%H_%M_%S"
# Sub-folder of the raw layer holding the key snapshots used for deletes.
KEY_SNAPSHOT_FOLDER = "primary_keys"
# Load types a run accepts; the last runs both in turn.
LOAD_TYPES = ("full_load", "initial_load", "full-initial")
# Parts of a table name.
TABLE_NAME_PARTS = 3
# --- end of fixed values ------------------------------------------------------

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_$#]*$")


def check_identifier(name: str) -> str:
    """Reject names that could smuggle SQL into a generated statement."""
    if not isinstance(name, str) or not _IDENT.match(name):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


@dataclass(frozen=True)
class TableRef:
    """``database.schema.table`` on a named server.

    ``source_name`` is the bracket-quoted form used when reading from a
    relational source; ``target_name`` drops the ``$`` that some source tables
    carry, for file and catalog targets.
    """

    database: str
    schema: str
    table: str
    server: str = ""

    @classmethod
    def parse(cls, qualified: str, server: str = "", parts: int = TABLE_NAME_PARTS) -> "TableRef":
        pieces = [p.strip() for p in qualified.split(".")]
        if len(pieces) != parts:
            raise ValueError(f"table name must have {parts} parts: {qualified!r}")
        if parts == 3:
            database, schema, table = pieces
        else:
            raise ValueError("only three-part names are supported")
        if not database or not table:
            raise ValueError(f"empty name part in {qualified!r}")
        return cls(database, schema, table, server)

    @property
    def target_name(self) -> str:
        return self.table.replace("$", "")

    @property
    def source_name(self) -> str:
        return f"[{self.table}]"

    @property
    def qualified_source(self) -> str:
        """``schema.[table]``: the raw name, bracket-quoted (linked servers)."""
        return f"{self.schema}.{self.source_name}" if self.schema else self.source_name

    @property
    def plain_source(self) -> str:
        """``schema.table`` with the ``$`` dropped (direct connections)."""
        return f"{self.schema}.{self.target_name}" if self.schema else self.target_name


@dataclass(frozen=True)
class LoadWindow:
    """Inclusive ``[start, end]`` of a watermark-bounded load."""

    start: datetime
    end: datetime

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError(f"window end {self.end} before start {self.start}")

    @staticmethod
    def parse_time(text: str) -> datetime:
        try:
            return datetime.strptime(text.strip(), TIME_FORMAT)
        except (ValueError, AttributeError) as exc:
            raise ValueError(f"expected 'yyyy-mm-dd hh:mm:ss', got {text!r}") from exc

    @classmethod
    def resolve(cls, *, stored_mark: datetime | None, given_start: str | None,
                given_end: str | None, run_time: datetime, overlap_minutes: str | int = 0,
                source_zone: str | None = None) -> "LoadWindow":
        """Window of one incremental run.

        * start = the given start, else the stored mark; minus the overlap
          (a string of digits or an int, as the schedulers pass it).
        * end = the given end, else the run time.
        * Bounds that were *not* given are shifted from UTC into
          ``source_zone`` (the zone of the source's load timestamps); given
          bounds are taken as already in that zone.  The zone is explicit:
          nothing depends on the machine's local zone.
        """
        overlap = str(overlap_minutes)
        if not overlap.isdigit():
            raise ValueError(f"overlap must be a count of minutes, got {overlap_minutes!r}")
        if given_start:
            start = cls.parse_time(given_start)
        elif stored_mark is not None:
            start = _utc_to_zone(stored_mark, source_zone)
        else:
            raise ValueError("no start given and no stored mark")
        start = start - timedelta(minutes=int(overlap))
        end = cls.parse_time(given_end) if given_end else _utc_to_zone(run_time, source_zone)
        return cls(start, end)


def _utc_to_zone(ts: datetime, zone: str | None) -> datetime:
    if not zone:
        return ts.replace(tzinfo=None)
    aware = ts.replace(tzinfo=ZoneInfo("UTC")) if ts.tzinfo is None else ts
    return aware.astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def run_folder(root: str, ref: TableRef, run_time: datetime | str) -> str:
    """``<root>/<db>/<table>/YYYY_MM_DD/YYYY_MM_DD-HH_MM_SS``."""
    if isinstance(run_time, str):
        run_time = LoadWindow.parse_time(run_time)
    day = run_time.strftime(RUN_DAY_FORMAT)
    stamp = run_time.strftime(RUN_STAMP_FORMAT)
    return f"{root.rstrip('/')}/{ref.database}/{ref.target_name}/{day}/{stamp}"


@dataclass(frozen=True)
class MemberFilter:
    """Group-member filter (J5): facts keep ids that are members of a group
    whose ``reporting`` code is in ``codes``."""

    members_key: str          # member table column pointing at the group
    groups_key: str           # group table key
    member_id: str            # member table column holding the fact id
    codes: tuple[str, ...]
    reporting_col: str = "reporting"

    def __post_init__(self):
        for name in (self.members_key, self.groups_key, self.member_id, self.reporting_col):
            check_identifier(name)
        if not self.codes:
            raise ValueError("member filter needs at least one reporting code")
        object.__setattr__(self, "codes", tuple(str(c) for c in self.codes))


@dataclass(frozen=True)
class TimeSpec:
    """Per-table time normalisation.

    ``zones``: ``[(column, zone)]`` of local wall-clock columns to turn into
    UTC.  ``formats``: ``[(column, pattern)]`` of text with an offset to parse.
    """

    zones: tuple[tuple[str, str], ...] = ()
    formats: tuple[tuple[str, str], ...] = ()


def load_steps(load_type: str) -> list[str]:
    """M7: which load steps a run performs, in order."""
    if load_type not in LOAD_TYPES:
        raise ValueError(f"unknown load type {load_type!r}; expected one of {LOAD_TYPES}")
    return ["full_load", "initial_load"] if load_type == "full-initial" else [load_type]


def sets_mark(step: str) -> bool:
    """M8: only initial loads record a watermark."""
    return step == "initial_load"


def primary_keys(keys: dict[str, list[str]], table: str) -> list[str]:
    """M9: primary key columns of a table; a table without keys is an error."""
    cols = keys.get(table) or []
    if not cols:
        raise ValueError(f"primary keys not configured for table {table!r}")
    return [check_identifier(c) for c in cols]


# --- fixed values: the source system's configuration -------------------------
# Primary keys of the incrementally loaded tables.
DEFAULT_PRIMARY_KEYS = {
    "ms_f_invoiceheader_history": ["InvoiceNumber"],
    "wo_f_workorder_header": ["WONo"],
    "wo_f_workorder_partdetail": ["WONo", "SegmentNo", "PartNo", "SeqNo"],
}

# Local wall-clock columns recorded in fixed Eastern Standard Time, and text
# columns carrying their own offset.
DEFAULT_TIME_SPECS = {
    "saleslink_wap_meetings": TimeSpec(zones=(
        ("MeetingDate", "EST"), ("NextMeetingDate", "EST"), ("EnterDateTime", "EST"),
        ("UpdateDateTime", "EST"), ("CompletedDateTime", "EST"), ("EndMeetingDate", "EST"),
        ("EndNextMeetingDate", "EST"), ("CallStart", "EST"))),
    "x_user": TimeSpec(zones=(("EnterDate", "EST"), ("ChangeDate", "EST"))),
    "ms_f_invoiceheader_history": TimeSpec(zones=(("ETLTimestamp", "EST"),)),
    "wo_f_workorder_header": TimeSpec(zones=(("ETLTimestamp", "EST"),)),
    "wo_f_workorder_partdetail": TimeSpec(zones=(("ETLTimestamp", "EST"),)),
    "equipment": TimeSpec(formats=(("ModifiedDate", "yyyy-MM-dd HH:mm:ss z"),)),
    "conditionsummary": TimeSpec(formats=(("ModifiedDate", "yyyy-MM-dd HH:mm:ss z"),)),
}

# Reporting codes that select the telephony groups served downstream.
AGENT_GROUP_CODES = ("520", "521", "522", "523", "524", "232")
QUEUE_GROUP_CODES = ("11311", "11312", "11313", "11314", "11315", "11328")
EXTENSION_GROUP_CODES = ("##502",)
# --- end of fixed values ------------------------------------------------------


def time_spec(table: str) -> TimeSpec | None:
    """The configured time columns of a source table, by its own name."""
    return DEFAULT_TIME_SPECS.get(table.lower())


AGENT_FILTER = MemberFilter("fkagentgroup", "pkey", "fkagent", AGENT_GROUP_CODES)
QUEUE_FILTER = MemberFilter("fkqueuegroup", "pkey", "fkqueue", QUEUE_GROUP_CODES)
EXTENSION_FILTER = MemberFilter("fkextensiongroup", "pkey", "fkextension", EXTENSION_GROUP_CODES)
