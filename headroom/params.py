"""Typed defaults shared by the operators. Every operator also takes them as arguments."""

from __future__ import annotations

ENTITY = "server_id"
TS = "timestamp"
METRICS = ("cpu_p95", "mem_p95", "disk_p95", "net_in_p95", "net_out_p95")
METADATA = ("business_unit", "region", "criticality")

# fixed values: feature and model settings whose results must be reproduced
LAGS = (1, 3, 7, 14, 30)
WINDOWS = (7, 30, 90)
OUTLIER_Z = 4.0
OUTLIER_WINDOW = 30
EOQ_MONTHS = (3, 6, 9, 12)
EOQ_DAYS = 7
MIN_HISTORY = 365
HORIZON = 90
RISK_THRESHOLD = 80.0
HIGH_FACTOR = 1.2
UNDERUSE_THRESHOLD = 30.0
CLUSTERS = 3
COST_PER_SERVER = 100.0
SAVED_SHARE = 0.5
KNN_NEIGHBOURS = 5
MISSING_WARN_PCT = 5.0
ROW_TOLERANCE = 100
INTERVAL_Z80 = 1.2816
SES_ALPHA = 0.3
DF_CRITICAL_5PCT = -2.86

# Execution settings. A series is cut into time segments of this many hours, so that no task
# ever holds a whole entity; a year and a half of daily rows is far below one task's memory.
SEGMENT_HOURS = 512 * 24
# Rows per chunk when windows run on row positions.
CHUNK_ROWS = 2048
# Copies of a per-entity statistic when it is joined back to rows of that entity.
SALTS = 8
