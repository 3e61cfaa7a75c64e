"""Parameters of a reconciliation, with the values the results depend on as defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# Tag keys and tag values of the map community's data model.
REF_KEY = "ref:hjertestarterregister"
TAG_KEY = "emergency"
TAG_VALUE = "defibrillator"
STANDALONE_VALUES = ("defibrillator", "aed")
OPT_OUT_KEYS = ("note", "fixme")
CONFLICT_KEYS = ("amenity", "leisure", "tourism", "shop", "office", "craft", "club")
MOVED_KEYS = (
    "emergency",
    "emergency:phone",
    "defibrillator:location",
    "defibrillator:code",
    "defibrillator:cabinet",
    "defibrillator:cabinet:manufacturer",
    "defibrillator:cabinet:colour",
    "ref:hjertestarterregister",
)

# Issue types, with the labels a dashboard shows for them.
OUTSIDE = "register_aed_outside_norway"
MISSING = "register_missing_required_data"
OPTED_OUT = "osm_node_note_opt_out"
NOT_A_NODE = "osm_not_a_node"
TOLERATED = "managed_node_location_within_tolerance"
KEPT_MIXED = "skipped_delete_not_aed_only"
ISSUE_LABELS = {
    "register_aed_outside_norway": "Register AED outside Norway polygon",
    "register_missing_required_data": "Register AED missing required data",
    "osm_node_note_opt_out": "OSM node opted out via note or fixme tag",
    "osm_not_a_node": "OSM element is not a node",
    "managed_node_location_within_tolerance": "Managed node moved in OSM (kept existing location)",
    "skipped_delete_not_aed_only": "Skipped delete due to non-AED tags",
}

# Text written by the retention and timeout jobs of the run log.
STUCK_MESSAGE = "Job marked as failed by pg_cron due to timeout"


def _national_boundary():
    from siteconcord.sources.boundary import NATIONAL_BOUNDARY

    return NATIONAL_BOUNDARY


@dataclass(frozen=True)
class MatchParams:
    """Everything a reconciliation can be told; the defaults are the published settings."""

    ref_key: str = REF_KEY
    tag_key: str = TAG_KEY
    tag_value: str = TAG_VALUE
    standalone_values: tuple[str, ...] = STANDALONE_VALUES
    opt_out_keys: tuple[str, ...] = OPT_OUT_KEYS
    conflict_keys: tuple[str, ...] = CONFLICT_KEYS
    moved_keys: tuple[str, ...] = MOVED_KEYS
    emergency_phone: str = "113"
    changed_location_m: float = 100.0
    quiet_location_m: float = 2.0
    merge_radius_m: float = 175.0
    max_delete_fraction: float = 0.5
    # Multipolygon as nested lists: polygons -> rings (outer first) -> (lon, lat) pairs, rings closed.
    boundary: tuple = field(default_factory=_national_boundary)
