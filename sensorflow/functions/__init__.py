from sensorflow.functions.missing import (  # noqa: F401
    is_finite, mean_skip, mean_strict, nan_to_null, nan_to_null_all, standard_error,
)
from sensorflow.functions.timefmt import (  # noqa: F401
    day_of, hour_floor, month_key, parse_timestamp,
)
from sensorflow.functions.names import forecast_file_name, parse_forecast_name  # noqa: F401
