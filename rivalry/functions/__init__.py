from rivalry.functions.dates import as_date, dt_value, latest_snapshot, trailing, window_predicate
from rivalry.functions.numeric import AMOUNT_TYPE, GMV_TYPE, MONEY_SCALE, money_out, ratio
from rivalry.functions.urls import normalise_url

__all__ = ["as_date", "dt_value", "latest_snapshot", "trailing", "window_predicate", "AMOUNT_TYPE", "GMV_TYPE",
           "MONEY_SCALE", "money_out", "ratio", "normalise_url"]
