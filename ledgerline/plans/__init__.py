"""The business queries, the staged run, the ad-hoc statements and the usage inventory."""
