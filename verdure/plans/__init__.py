"""Named reports: functions from a mapping of tables to a DataFrame."""
