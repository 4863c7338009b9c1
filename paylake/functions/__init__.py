"""Column expressions — all built from ``pyspark.sql.functions``, no UDFs."""

from paylake.functions.buckets import (  # noqa: F401
    amount_bucket, day_type_label, fiscal_quarter, is_success, is_success_int,
    population_bucket, season, time_of_day,
)
from paylake.functions.calendar import (  # noqa: F401
    date_key, day_name, day_of_week_num, day_short, is_month_end, is_month_start,
    is_source_festival, is_weekend_day, local_time, month_name, month_short,
)
from paylake.functions.keys import surrogate_key  # noqa: F401
from paylake.functions.numeric import (  # noqa: F401
    money_sum, percent, rounded_avg, safe_ratio, scaled_millions,
)
from paylake.functions.text import lake_city_key, lower_trim, upper_trim  # noqa: F401
