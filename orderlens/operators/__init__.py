"""DataFrame operators: conforming transforms, per-order totals, global ranking."""
