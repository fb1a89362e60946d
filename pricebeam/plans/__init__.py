"""Jobs, dashboard views and the registered queries."""
