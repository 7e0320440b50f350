"""DataFrame operators: cleaning and ledger, resolution, positions, emissions, marts, reports, reconciliation, metrics."""
