"""Engine options: names, defaults, the key=value file, command-line precedence and conflicts."""

from __future__ import annotations

import dataclasses
import sys
from dataclasses import dataclass, field
from pathlib import Path

ENCODINGS = {"base64": "base64", "b64": "base64", "none": "none", "raw": "none"}
TRUE, FALSE = {"1", "true", "yes", "y"}, {"0", "false", "no", "n"}
#: Accepted for compatibility; Spark schedules, retries and stores by itself.
IGNORED = [
    "sync_protocol", "local_ip", "local_port", "master_ip", "master_port", "master_auth", "log_path", "log_rotate_interval", "dump_path", "checkpoint_path",
    "kafka_brokers", "kafka_client_id", "kafka_message_max_bytes", "kafka_enable_idempotence", "wait_bgsave_timeout", "binlog_workers", "binlog_queue_size",
    "window_slots", "sender_batch_size", "binlog_progress_interval", "pb_ack_delay_warn", "pb_idle_timeout", "wal_dir", "wal_segment_bytes", "wal_sync_every",
    "snapshot_workers", "snapshot_cgo_batch", "snapshot_scan_batch", "snapshot_scan_strategy",
]


@dataclass
class Options:
    db_name: str = "db0"
    source_id: str = "127.0.0.1:0"
    kafka_stream_mode: str = "dual"
    kafka_topic_snapshot: str = "feed.snapshot"
    kafka_topic_binlog: str = "feed.binlog"
    kafka_topic_single: str = "feed.single"
    args_encoding: str = "base64"
    raw_resp_encoding: str = "base64"
    include_raw_resp: bool = True
    snapshot_batch_num: int = 512
    snapshot_list_tail_n: int = 0
    snapshot_reader_mode: str = "type"
    snapshot_reader_types: list[str] = field(default_factory=list)
    snapshot_reader_prefixes: list[str] = field(default_factory=list)
    filters: list[str] = field(default_factory=list)
    excludes: list[str] = field(default_factory=list)
    filenum: int | None = None
    offset: int | None = None
    start_from_master: bool = False
    initial_full_sync: bool = True
    sync_point_purged_action: str = "full_sync"
    wal_retain_segments: int = 2
    on_error: str = "fail"
    warnings: list[str] = field(default_factory=list)
    extra: dict[str, str] = field(default_factory=dict)


def parse_bool(text: str) -> bool:
    if (low := text.strip().lower()) in TRUE | FALSE:
        return low in TRUE
    raise ValueError(f"not a boolean: {text!r}")


def parse_list(text: str) -> list[str]:
    return [x for x in (p.strip() for p in text.split(",")) if x]


def folder(path: str) -> str:
    return path if not path or path.endswith("/") else path + "/"


def set_option(o: Options, name: str, value: str) -> None:
    """Set one option by its file name. Bad values and unknown names become warnings."""
    name = name.strip().lower()
    kinds = {f.name: f.type for f in dataclasses.fields(Options) if f.name not in ("filters", "excludes", "warnings", "extra")}
    try:
        if name == "filter":
            o.filters.append(value)
        elif name in ("exclude", "exclude_keys"):
            o.excludes.append(value)
        elif name in ("args_encoding", "raw_resp_encoding"):
            if value.strip().lower() not in ENCODINGS:
                raise ValueError(f"not an encoding: {value!r}")
            setattr(o, name, ENCODINGS[value.strip().lower()])
        elif name in kinds:
            kind = kinds[name]
            setattr(o, name, parse_bool(value) if kind == "bool" else parse_list(value) if kind.startswith("list") else int(value) if kind.startswith("int") else value)
        elif name in IGNORED:
            o.extra[name] = folder(value) if name in ("log_path", "dump_path", "wal_dir") else value
            if name == "sync_protocol":
                o.warnings.append("sync_protocol is ignored")
        else:
            o.warnings.append(f"unknown option {name}")
    except ValueError as e:
        o.warnings.append(f"{name}: {e}")


def load_lines(lines, o: Options | None = None) -> Options:
    """Read key=value lines; # and ; begin comments."""
    o = o or Options()
    for line in (raw.strip() for raw in lines):
        if not line or line[0] in "#;":
            continue
        name, found, value = line.partition("=")
        if found:
            set_option(o, name, value.strip())
        else:
            o.warnings.append(f"no '=' in {line!r}")
    return o


def expand_filters(specs: list[str]) -> list[str]:
    """A spec without '=' is a file of specs, one a line, # for comments."""
    out = []
    for spec in specs:
        if "=" in spec:
            out.append(spec)
        elif spec.strip():
            out += [x for x in (line.strip() for line in Path(spec).read_text().splitlines()) if x and x[0] != "#"]
    return out


def conflicts(o: Options) -> list[str]:
    """Why the start position can't be told; the command line ends with status 2 then."""
    given = [(o.filenum is not None or o.offset is not None), o.start_from_master, o.initial_full_sync]
    out = []
    if (o.filenum is None) != (o.offset is None):
        out.append("filenum and offset go together")
    if sum(given) > 1:
        out.append("only one of filenum and offset, start_from_master, initial_full_sync")
    return out


def from_args(argv: list[str]) -> Options:
    """-C/-config FILE, then -set k=v, each over the one before; -F and -X add filters and excludes."""
    import argparse

    p = argparse.ArgumentParser(prog="tideline", allow_abbrev=False)
    p.add_argument("-C", "-config", dest="config")
    p.add_argument("-set", dest="sets", action="append", default=[])
    p.add_argument("-F", dest="filters", action="append", default=[])
    p.add_argument("-X", dest="excludes", action="append", default=[])
    a = p.parse_args(argv)
    o = load_lines(Path(a.config).read_text().splitlines() if a.config else [])
    for pair in a.sets:
        name, _, value = pair.partition("=")
        set_option(o, name, value)
    o.filters, o.excludes = expand_filters(o.filters + a.filters), o.excludes + a.excludes
    if bad := conflicts(o):
        print("; ".join(bad), file=sys.stderr)
        raise SystemExit(2)
    return o


def start_position(o: Options, stored: tuple[int, int] | None, current: tuple[int, int] | None) -> tuple[str, tuple[int, int] | None]:
    """Where a log stream begins: an explicit position, the primary's current one, the stored checkpoint, or else a snapshot first."""
    if o.filenum is not None and o.offset is not None:
        return "position", (o.filenum, o.offset)
    if o.start_from_master and current is not None:
        return "position", current
    if o.initial_full_sync and stored is None:
        return "snapshot", None
    return ("position", stored) if stored is not None else ("latest", None)


def after_purge(o: Options, current: tuple[int, int] | None) -> tuple[str, tuple[int, int] | None]:
    """What to do when the wanted position is gone: take a snapshot, go on from the current position, or stop. Unknown actions mean a snapshot."""
    action = o.sync_point_purged_action.strip().lower()
    if action == "start_from_master" and current is not None:
        return "position", current
    return ("stop", None) if action == "pause" else ("snapshot", None)
