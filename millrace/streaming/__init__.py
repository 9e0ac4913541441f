"""The merge and the state machines over streams."""
