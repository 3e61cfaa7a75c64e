"""Weekly opening hours: from numbers to the tag's text, and from the text to a state at an instant."""

from __future__ import annotations

from siteconcord.functions.text import let, literal, trimmed

# Day codes of the opening_hours tag, and of the registry's column names.
DAYS = ("Mo", "Tu", "We", "Th", "Fr", "Sa", "Su")
REGISTRY_DAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def format_hhmm(c: str) -> str:
    """1630 -> '16:30'; null unless it is a time of day up to 24:00."""
    whole = f"CASE WHEN double({c}) > -1 AND double({c}) < 2401 THEN int({c}) END"
    shown = (
        "CASE WHEN t BETWEEN 0 AND 2400 AND t % 100 < 60 "
        "THEN concat(lpad(t div 100, 2, '0'), ':', lpad(t % 100, 2, '0')) END"
    )
    return let(whole, "t", shown)


def day_intervals() -> str:
    """The seven '08:00-16:00' texts of an asset, null where an end is missing or no time of day."""
    ends = ((f"OPENING_HOURS_{day}_FROM", f"OPENING_HOURS_{day}_TO") for day in REGISTRY_DAYS)
    return f"array({', '.join(f'concat({format_hhmm(a)}, {literal("-")}, {format_hhmm(b)})' for a, b in ends)})"


def merge_day_runs(intervals: str) -> str:
    """'Mo-Fr 08:00-16:00' for each run of adjacent days with one interval; a day without one ends the run."""
    parts = []
    for i, day in enumerate(DAYS):
        begins = f"{intervals}[{i}] IS NOT NULL"
        if i:
            begins += f" AND NOT {intervals}[{i - 1}] <=> {intervals}[{i}]"
        stops = [
            f"CASE WHEN NOT {intervals}[{j}] <=> {intervals}[{i}] THEN '-{DAYS[j - 1]}' END" for j in range(i + 1, 7)
        ]
        last = f"coalesce({', '.join([*stops, literal('-Su')])})"
        shown = f"concat('{day}', replace({last}, '-{day}', ''), ' ', {intervals}[{i}])"
        parts.append(f"CASE WHEN {begins} THEN {shown} END")
    return f"filter(array({', '.join(parts)}), part -> part IS NOT NULL)"


def opening_hours() -> str:
    """The opening_hours tag of a registry asset, from its columns; null without any valid day."""
    holidays = (
        "CASE OPENING_HOURS_CLOSED_HOLIDAYS WHEN 'Y' THEN array('PH off') WHEN 'N' THEN array('PH open') "
        "ELSE cast(array() AS array<string>) END"
    )
    joined = f"CASE WHEN size(runs) > 0 THEN array_join(concat(runs, {holidays}), '; ') END"
    return let(day_intervals(), "week", let(merge_day_runs("week"), "runs", joined))


def easter_sunday(year: str) -> str:
    """Date of Easter in the Gregorian calendar."""
    golden, century = f"({year} % 19)", f"({year} div 100)"
    moon = f"(({century} - {century} div 4 - ({century} * 8 + 13) div 25 + {golden} * 19 + 15) % 30)"
    full = f"(m - m div 28 * (1 - 29 div (m + 1) * ((21 - {golden}) div 11)))"
    weekday = f"(({year} + {year} div 4 + f + 2 - {century} + {century} div 4) % 7)"
    # Days after the last day of February, less 28.
    date = f"date_add(make_date(int({year}), 3, 1), int(f - {weekday} + 27))"
    return let(moon, "m", let(full, "f", date))


def is_norwegian_holiday(day: str) -> str:
    # Holidays on a date, and days from Easter Sunday of the movable ones.
    dated = "'01-01', '05-01', '05-17', '12-25', '12-26'"
    from_easter = "-3, -2, 0, 1, 39, 49, 50"
    return (
        f"(date_format({day}, 'MM-dd') IN ({dated}) OR "
        f"datediff({day}, {easter_sunday(f'year({day})')}) IN ({from_easter}))"
    )


_TIME = "(?:[01][0-9]|2[0-4]):[0-5][0-9]"
_DAY = "(?:Mo|Tu|We|Th|Fr|Sa|Su)"
_RULE = (
    f"^(?:24/7|off|closed|open|PH (?:off|closed|open)|(?:{_DAY}(?:-{_DAY})? )?{_TIME}-{_TIME}"
    f"|{_DAY}(?:-{_DAY})? (?:off|closed))$"
)


def _rules(value: str) -> str:
    """Rules as struct(first, last, on_holidays, start, stop); minutes of the day, both null when closed."""
    week = f"array({', '.join(literal(d) for d in DAYS)})"

    def minute(at):
        return f"int(substr(times, {at}, 2)) * 60 + int(substr(times, {at + 3}, 2))"

    is_open = "rule RLIKE '(24/7|open)$'"
    fields = (
        f"'first', CASE WHEN days <> '' THEN int(array_position({week}, left(days, 2))) - 1 ELSE 0 END, "
        f"'last', CASE WHEN days <> '' THEN int(array_position({week}, right(days, 2))) - 1 ELSE 6 END, "
        "'on_holidays', startswith(rule, 'PH'), "
        f"'start', CASE WHEN {is_open} THEN 0 WHEN times <> '' THEN {minute(1)} END, "
        f"'stop', CASE WHEN {is_open} THEN 1440 WHEN times <> '' THEN {minute(7)} END"
    )
    days = f"regexp_extract(rule, {literal(f'^({_DAY}(?:-{_DAY})?)')}, 1)"
    times = f"regexp_extract(rule, {literal(f'({_TIME}-{_TIME})$')}, 1)"
    parsed = let(days, "days", let(times, "times", f"named_struct({fields})"))
    return f"transform(split({value}, ';'), r -> {let(trimmed('r'), 'rule', parsed)})"


def _deciding(rules: str, day: str) -> str:
    """The last rule that speaks about a day; null if none does."""
    in_days = (
        "CASE WHEN r.first > r.last THEN wd >= r.first OR wd <= r.last ELSE wd BETWEEN r.first AND r.last END"
    )
    holiday = is_norwegian_holiday(day)
    chosen = f"try_element_at(filter({rules}, r -> CASE WHEN r.on_holidays THEN {holiday} ELSE {in_days} END), -1)"
    return let(f"weekday({day})", "wd", chosen)


def opening_state(value: str, at_utc: str, zone: str = "Europe/Oslo") -> str:
    """unspecified, unknown, open or closed at an instant, judged on the wall clock of the zone.

    Understands the texts `opening_hours` writes plus '24/7' and 'off'; anything else is unknown.
    """
    minute = "(hour(wall) * 60 + minute(wall))"
    today = f"coalesce({minute} >= now.start AND (now.stop <= now.start OR {minute} < now.stop), false)"
    spill = f"coalesce(before.stop <= before.start AND {minute} < before.stop, false)"
    judged = f"CASE WHEN {today} OR {spill} THEN 'open' ELSE 'closed' END"
    judged = let(_deciding("rules", "date_sub(date(wall), 1)"), "before", judged)
    judged = let(_deciding("rules", "date(wall)"), "now", judged)
    judged = let(_rules("text"), "rules", judged)
    judged = let(f"from_utc_timestamp({at_utc}, {literal(zone)})", "wall", judged)
    known = f"forall(split(text, ';'), r -> {trimmed('r')} RLIKE {literal(_RULE)})"
    state = f"CASE WHEN text IS NULL OR text = '' THEN 'unspecified' WHEN NOT {known} THEN 'unknown' ELSE {judged} END"
    return let(trimmed(value), "text", state)
