"""Writers: records, reports, run logs, models."""
