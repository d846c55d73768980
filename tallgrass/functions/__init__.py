"""Column expressions: functions from columns to a column."""
