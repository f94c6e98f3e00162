from indexforge.functions.calendar import (  # noqa: F401
    date_text, date_to_epoch_ms, default_window, epoch_ms_to_date, ntz_to_epoch_ms,
    parse_date_text, previous_trading_day, trading_calendar, weekday_only,
)
from indexforge.functions.scalar import (  # noqa: F401
    cap_share, equal_share, json_line, money_text, percent_text, slug,
    weighted_price, with_default,
)
