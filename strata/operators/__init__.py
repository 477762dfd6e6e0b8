"""Generic DataFrame -> DataFrame operators; column names are arguments."""

from strata.operators.aggregate import conditional_kpis, preaggregate  # noqa: F401
from strata.operators.calendar import calendar, explode_days  # noqa: F401
from strata.operators.dedup import dedup_latest  # noqa: F401
from strata.operators.incremental import high_water, lookback, since_high_water  # noqa: F401
from strata.operators.joins import enrich  # noqa: F401
from strata.operators.merge import merge_upsert  # noqa: F401
from strata.operators.snapshot import latest_snapshot  # noqa: F401
from strata.operators.windows import trailing_mean  # noqa: F401
