"""siteconcord: reconcile two snapshots of geo-tagged records with Spark DataFrames."""

from siteconcord.params import MatchParams

__all__ = ["MatchParams"]
