"""The analytic jobs, one module per domain."""
