"""Tag maps: predicates, differences, merges, and the mapping from an asset to its target tags."""

from __future__ import annotations

from siteconcord.functions.geo import is_finite
from siteconcord.functions.hours import opening_hours
from siteconcord.functions.text import (
    cabinet_colour,
    cabinet_kind,
    cabinet_manufacturer,
    clean_tag_value,
    extract_emails,
    extract_phones,
    let,
    literal,
    number_text,
    trimmed,
)
from siteconcord.params import MatchParams

NO_TAGS = "cast(map() AS map<string,string>)"


def or_empty(tags: str) -> str:
    return f"coalesce({tags}, {NO_TAGS})"


def tag(tags: str, key: str) -> str:
    return f"{tags}[{literal(key)}]"


def has_key(tags: str, key: str) -> str:
    """Whether the key is there, whatever its value."""
    return f"coalesce(map_contains_key({tags}, {literal(key)}), false)"


def _filled(value: str) -> str:
    return f"coalesce({value} <> '', false)"


def _any(tests) -> str:
    return "(" + (" OR ".join(tests) or "false") + ")"


def _listed(values) -> str:
    return ", ".join(literal(v) for v in values)


def managed_ref(tags: str, p: MatchParams) -> str:
    """The trimmed reference, null when the element is not managed."""
    return f"nullif({trimmed(tag(tags, p.ref_key))}, '')"


def is_linked(tags: str, p: MatchParams) -> str:
    """A reference is present, even one of blanks only."""
    return _filled(tag(tags, p.ref_key))


def is_opted_out(tags: str, p: MatchParams) -> str:
    return _any(_filled(tag(tags, key)) for key in p.opt_out_keys)


def has_conflict_tags(tags: str, p: MatchParams) -> str:
    """Any key of another primary feature, whatever its value."""
    return _any(has_key(tags, key) for key in p.conflict_keys)


def is_aed_only(tags: str, p: MatchParams) -> str:
    kind = f"coalesce({tag(tags, p.tag_key)} IN ({_listed(p.standalone_values)}), false)"
    return f"({kind} AND NOT {has_conflict_tags(tags, p)})"


def tag_updates(current: str, wanted: str) -> str:
    """Entries of wanted that current lacks or holds with another value."""
    return f"map_filter({wanted}, (k, v) -> NOT v <=> {or_empty(current)}[k])"


def merge_tags(current: str, updates: str) -> str:
    """Both maps together; the second wins on a shared key."""
    return f"map_concat(map_filter({or_empty(current)}, (k, v) -> NOT map_contains_key({updates}, k)), {updates})"


def without_keys(tags: str, keys) -> str:
    return f"map_filter({or_empty(tags)}, (k, v) -> k NOT IN ({_listed(keys)}))"


def only_keys(tags: str, keys) -> str:
    return f"map_filter({or_empty(tags)}, (k, v) -> k IN ({_listed(keys)}))"


def drop_undefined(tags: str) -> str:
    return f"map_filter({or_empty(tags)}, (k, v) -> v IS NOT NULL)"


def apply_tag_updates(current: str, updates: str) -> str:
    """Merge, where a null value removes its key."""
    return drop_undefined(merge_tags(current, updates))


def tags_from(entries: list[tuple[str, str]]) -> str:
    """Map of the entries (key, value expression) whose value is not null."""
    pairs = ", ".join(f"named_struct('key', {literal(k)}, 'value', string({v}))" for k, v in entries)
    return f"map_from_entries(filter(array({pairs}), e -> e.value IS NOT NULL))"


def tags_text(tags: str) -> str:
    """The map as 'key=value' lines in binary order, joined by '|'."""
    return f"array_join(array_sort(transform(map_entries({tags}), e -> concat(e.key, '=', e.value))), '|')"


def level(floor: str) -> str:
    return f"CASE WHEN {is_finite(floor)} THEN {number_text(floor)} END"


def map_asset_to_tags(p: MatchParams) -> str:
    """Target tags of a registry asset, from its columns."""
    return let(
        "coalesce(SITE_DESCRIPTION, '')",
        "d",
        tags_from(
            [
                (p.tag_key, literal(p.tag_value)),
                ("emergency:phone", literal(p.emergency_phone)),
                (p.ref_key, "ASSET_GUID"),
                ("name", clean_tag_value("SITE_NAME")),
                ("level", level("SITE_FLOOR_NUMBER")),
                ("defibrillator:location", clean_tag_value("d")),
                ("email", f"array_join({extract_emails('d')}, '; ')"),
                ("phone", f"array_join({extract_phones('d')}, '; ')"),
                ("opening_hours", opening_hours()),
                ("defibrillator:cabinet", cabinet_kind("d")),
                ("defibrillator:cabinet:colour", cabinet_colour("d")),
                ("defibrillator:cabinet:manufacturer", cabinet_manufacturer("d")),
            ]
        ),
    )
