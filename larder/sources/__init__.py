"""Sources (CSV scan, test-table domain), table schemas and the publishing sink."""
