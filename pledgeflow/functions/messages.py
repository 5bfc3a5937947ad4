"""Rejection texts."""

# The texts users of the rules already know.
USER_WITHOUT_ROLE = "User must be a Creator or a Buyer, or both!"
PLEDGE_BELOW_MINIMUM = "Pledge amount must be greater than minimum of reward tier"
NO_REWARD_LEVELS = "No reward levels for project"
REFUND_NOT_REQUESTED = "cannot approve or reject refund that is not requested"
REFUND_TOO_LATE = "request date is 90 days after deadline, employee can only reject request"
PLEDGE_OUTSIDE_DATES = "cannot back before project creation or after project deadline"
PROJECT_NOT_SUCCESSFUL = "no refund on unsuccessful project"
UNKNOWN_KIND = "Nonexistent kind --> %s"

# Texts for the table constraints.
NULL_VALUE = "null value in {table}.{column}"
CHECK_FAILED = "check failed on {table}: {check}"
KEY_STORED = "duplicate key in {table}: already stored"
KEY_REPEATED = "duplicate key in {table}: repeated in batch"
PARENT_MISSING = "missing parent: {table} {label}"
NO_SUCH_PLEDGE = "no such pledge"
REQUEST_LOCKED = "refund request already set"
CHANGE_AMBIGUOUS = "several changes for one pledge"
