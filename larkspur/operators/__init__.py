"""Rule, integrity, enrichment, temporal, report and scoring operators, each DataFrame to DataFrame."""
