"""Read models, batch jobs and the registered queries."""
