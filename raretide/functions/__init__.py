from raretide.functions.timecols import (HOUR_US, DAY_US, ts_micros, hours_between, trunc_hour,
                                         half_open_us, parse_span_us)
from raretide.functions.scalar import (safe_div, threshold_predict, decision_alert, decision_risk,
                                       round_response, interaction_columns, clean_double)

__all__ = ["HOUR_US", "DAY_US", "ts_micros", "hours_between", "trunc_hour", "half_open_us", "parse_span_us",
           "safe_div", "threshold_predict", "decision_alert", "decision_risk", "round_response",
           "interaction_columns", "clean_double"]
