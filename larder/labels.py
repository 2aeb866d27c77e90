"""Names and texts that must read exactly as in the original scripts' outputs.

Fixed values, in the order the scripts produce them.
"""

# Bad-value count columns of the inventory profile.
BAD_SNAPSHOT_ID = "Bad_SnapshotInvID"
BAD_PRODUCT_ID = "Bad_ProductID"
BAD_PRODUCT_NAME = "Bad_ProductName"
BAD_WAREHOUSE = "Bad_WarehouseLocation"
BAD_AVAILABILITY = "Bad_Availability"
BAD_DEMAND = "Bad_Demand"
BAD_SNAPSHOT_DATE = "Bad_SnapshotDate"

# Per-product mean aliases used by the imputation.
AVG_DEMAND = "avg_demand"
AVG_AVAILABILITY = "avg_availability"

# NULL re-check report columns.
NULL_COUNT = "NullCount"
COLUMN_NAME = "ColumnName"

# Duplicate report status and duplicate-check count column.
DUPLICATE_STATUS = "This is a duplicate row"
DUPLICATE_COUNT = "DuplicateCount"

# Cap message prefixes.
CAP_DEMAND_MESSAGE = "Capping Demand at: "
CAP_AVAILABILITY_MESSAGE = "Capping Availability at: "

# Post-capping profile metric labels and columns.
METRIC_DEMAND = "unitsDemanded After Capping"
METRIC_AVAILABILITY = "unitsAvailable After Capping"
PROFILE_COLUMNS = ("Metric", "MinValue", "MaxValue", "AvgValue")

# Business-rule report labels and columns.
ISSUE_ABOVE_DEMAND = "Availability > Demand"
ISSUE_NEGATIVE = "Negative Availability"
ISSUE_TYPE = "IssueType"
ISSUE_COUNT = "IssueCount"

# Row-count column.
TOTAL_RECORDS = "Total_Records"
