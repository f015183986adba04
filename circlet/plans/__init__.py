"""End-to-end plans, derived test inputs, registered queries and their SQL twins."""
