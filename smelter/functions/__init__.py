"""Column functions: casts that never raise, time bins and the risk score."""

from smelter.functions.casts import cast_lenient, ref
from smelter.functions.scoring import risk_score
from smelter.functions.timebins import bin_time, look_back, moment, time_after, utc_date

__all__ = ["bin_time", "cast_lenient", "look_back", "moment", "ref", "risk_score", "time_after", "utc_date"]
