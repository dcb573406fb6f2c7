"""The business reports (R1-R8) and the report runner."""
