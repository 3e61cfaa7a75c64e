"""Wording for dashboards: durations, relative times, numbers, change comments, links."""

from __future__ import annotations

from siteconcord.functions.text import let, literal


def _rounded(c: str) -> str:
    """Halves go up, also for negative numbers."""
    return f"floor({c} + 0.5D)"


def _millis_between(start: str, end: str) -> str:
    return f"timestampdiff(MILLISECOND, date_trunc('MILLISECOND', {start}), date_trunc('MILLISECOND', {end}))"


def duration_seconds(started: str, finished: str) -> str:
    return let(_millis_between(started, finished), "ms", f"CASE WHEN ms >= 0 THEN {_rounded('ms / 1000.0D')} END")


def duration_label(started: str, finished: str) -> str:
    """'12s', '3m 4s' or '2h 5m'; '-' when an end is missing or they are the wrong way round."""
    label = (
        "CASE WHEN s IS NULL THEN '-' WHEN s < 60 THEN format_string('%ds', s) "
        "WHEN s < 3600 THEN format_string('%dm %ds', s div 60, s % 60) "
        "ELSE format_string('%dh %dm', s div 3600, s div 60 % 60) END"
    )
    return let(duration_seconds(started, finished), "s", label)


def relative_time(at: str, now: str) -> str:
    """'5 minutes ago', 'in 2 hours', 'tomorrow'; each unit is rounded from the smaller one."""

    def phrase(n, unit, special):
        amount = f"concat(abs({n}), ' {unit}', CASE WHEN abs({n}) = 1 THEN '' ELSE 's' END)"
        cases = " ".join(f"WHEN {n} = {value} THEN '{text}'" for value, text in special.items())
        return f"CASE {cases} WHEN {n} < 0 THEN concat({amount}, ' ago') ELSE concat('in ', {amount}) END"

    words = (
        "CASE WHEN mi IS NULL THEN 'unknown' "
        f"WHEN abs(mi) < 60 THEN {phrase('mi', 'minute', {0: 'this minute'})} "
        f"WHEN abs(h) < 24 THEN {phrase('h', 'hour', {0: 'this hour'})} "
        f"ELSE {phrase('d', 'day', {0: 'today', 1: 'tomorrow', -1: 'yesterday'})} END"
    )
    words = let(_rounded("h / 24.0D"), "d", words)
    words = let(_rounded("mi / 60.0D"), "h", words)
    return let(_rounded(f"{_millis_between(now, at)} / 60000.0D"), "mi", words)


def format_datetime(ts: str) -> str:
    """'Jan 02, 2024, 03:04 PM', '-' on null."""
    return f"coalesce(date_format({ts}, 'MMM dd, yyyy, hh:mm a'), '-')"


def format_count(n: str) -> str:
    """'1,234', '-' on null."""
    return f"coalesce(format_number({n}, 0), '-')"


def change_comment(created: str, modified: str, deleted: str, subject: str) -> str:
    """'Added, Modified, and Deleted <subject>', naming only what happened; 'Updated' if nothing did."""
    labels = ", ".join(
        f"CASE WHEN {n} > 0 THEN '{label}' END"
        for n, label in ((created, "Added"), (modified, "Modified"), (deleted, "Deleted"))
    )
    listed = (
        "CASE size(done) WHEN 0 THEN 'Updated' WHEN 3 THEN 'Added, Modified, and Deleted' "
        "ELSE array_join(done, ' and ') END"
    )
    done = let(f"filter(array({labels}), label -> label IS NOT NULL)", "done", listed)
    return f"concat({done}, {literal(' ' + subject)})"


def element_url(kind: str, element_id: str) -> str:
    return f"concat('https://www.openstreetmap.org/', {kind}, '/', {element_id})"


def element_label(kind: str, element_id: str) -> str:
    return f"concat(initcap({kind}), ' ', {element_id})"
