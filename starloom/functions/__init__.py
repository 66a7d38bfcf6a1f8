from .codes import (REGION_STATE_PATTERN, VISA_CATEGORIES, char_cast, code_label,
                    region_state, upper_name)
from .dates import sas_day_to_timestamp, timestamp_to_sas_day
from .sql import register_sql_functions
from . import text

__all__ = [
    "REGION_STATE_PATTERN", "VISA_CATEGORIES", "char_cast", "code_label",
    "region_state", "upper_name", "sas_day_to_timestamp", "timestamp_to_sas_day",
    "register_sql_functions", "text",
]
