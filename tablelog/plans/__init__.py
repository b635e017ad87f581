"""Log plans: actions, segments, snapshots and predicates, decided before Catalyst sees a query."""
