"""Column-level functions: scalars (F1-F17), ratio rule (D4) and UDF/UDAF."""

from clickflow.functions.scalars import *  # noqa: F401,F403
from clickflow.functions.udfs import (  # noqa: F401
    concat_long_string,
    group_concat_distinct,
    json_field,
    register_sql_functions,
)
