"""Model wiring, registered queries, the SQL oracle and the build job."""
