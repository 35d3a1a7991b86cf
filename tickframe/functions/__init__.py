from .calendar import price_quarter, statement_quarter, statement_year  # noqa: F401
from .numeric import (exact_sum, exact_avg, safe_div, pct_error, minmax,  # noqa: F401
                      minmax_inverse, relative_upside, any_null)
