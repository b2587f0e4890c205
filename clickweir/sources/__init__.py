"""Where messages come from: a topic, or a stored copy of one."""
