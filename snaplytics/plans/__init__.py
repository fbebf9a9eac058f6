"""Jobs: analytics queries, reports, the BI view, and the transform / load pipeline."""
