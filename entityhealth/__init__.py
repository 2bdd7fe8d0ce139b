"""Entity health analytics on PySpark DataFrames.

Entities (animals, devices, accounts) report daily readings, owners write notes
and devices write log lines. The package scores every entity-day against rule
tables, finds anomalies, builds reports and keeps the tables up to date.
"""

from entityhealth.rules import DEFAULT_RULES, Baseline, CategoryRules, Metric, NoteSignal, RuleSet

__all__ = ["DEFAULT_RULES", "Baseline", "CategoryRules", "Metric", "NoteSignal", "RuleSet"]
