"""Named query plans (one per operator key) and job entry points."""
