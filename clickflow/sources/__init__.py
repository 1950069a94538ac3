"""Sources: table scans, JDBC/Kafka builders, ad-log parsing and TESTDATA fixtures."""

from clickflow.sources.readers import (  # noqa: F401
    jdbc_table,
    kafka_stream,
    parse_ad_log,
    read_table,
    scan_actions_by_date,
    scan_click_actions,
)
